"""Chat formatting, WARC archives and top-k search: round trips and brute force."""

import gzip
import hashlib
import itertools
import re
import time

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktrail.llm import chat, knn, warc
from clicktrail.llm.components import connected_components

TURNS = [
    [("user", "hello"), ("assistant", "<s>[INST] \\[/INST]</s>")],
    [("system", "</s>"), ("user", "a"), ("assistant", "b"), ("user", ""), ("assistant", "")],
    [("tool", "x"), (None, None), ("[ROLE]", "[/ROLE]"), ("a[/ROLE]b", "</s"), ("assistant", "s><"), ("user", "<\\\\s>")],
    [("assistant", " [/INST]"), ("assistant", "[INST] ok [/INST]"), ("user", "<"), ("user", "/s>")],
    [("assistant", "é\n\u2028 \U0001f600</s>\\</s>\\\\[SYS]"), ("assistant", "")],
    [],
]


def test_turns_come_back_whatever_they_say(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType()), *chat.RECORD, T.StructField("turns", T.StringType())])
    records = [(n, [(r, t) for r, t in turns], *[None] * 7, "clash") for n, turns in enumerate(TURNS)]
    out = chat.format_records(spark.createDataFrame(records, schema))
    parsed = out.select("record.n", chat.parse_turns(F.col("formatted")).alias("t"), chat.loss_texts(F.col("formatted"), F.col("loss")).alias("l"), "layout", "formatted")
    for r in parsed.collect():
        want = [(role or "", text or "") for role, text in TURNS[r.n]]
        assert [(t["role"], t["text"]) for t in r.t] == want
        assert r.l == [text for role, text in want if role == "assistant"]
        assert r.layout == "messages"


def many_turns(spark, n):
    rows = spark.range(n).select(
        F.lit(1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("h\u00e9llo </s> "), F.col("id").cast("string")).alias("text"),
    )
    item = lambda i: F.struct(i["role"].alias("role"), i["text"].alias("content"))
    return chat.conversations_of(rows).select("conv_id", F.transform("items", item).alias("messages"))


def test_long_conversations_cost_no_square(spark):
    seconds = {}
    for n in (8_000, 32_000):
        out = chat.format_records(many_turns(spark, n), T.StructType([chat.RECORD["messages"]]))
        started = time.monotonic()
        row = out.select("formatted", "loss", chat.loss_texts(F.col("formatted"), F.col("loss")).alias("texts")).first()
        seconds[n] = time.monotonic() - started
        assert row.texts == [f"h\u00e9llo </s> {i}" for i in range(1, n, 2)]
        assert [row.formatted[s.start : s.start + s.length] for s in row.loss] == [chat_escaped(t) for t in row.texts]
    assert seconds[32_000] < 8 * max(seconds[8_000], 1)


def chat_escaped(text):
    return re.sub(chat.ESCAPABLE, r"\1\2\\\3", text)


def test_byte_order_marks_stay_and_empty_tables_give_no_rows(spark):
    schema = T.StructType([chat.RECORD["messages"]])
    texts = ["\ufeffa\ufeff", "", "\ufeff", "\U0001f600"]
    records = spark.createDataFrame([([("assistant", t) for t in texts],)], schema)
    out = chat.format_records(records, schema)
    assert out.select(chat.loss_texts(F.col("formatted"), F.col("loss"))).first()[0] == texts
    assert chat.format_records(records.limit(0), schema).count() == 0


def test_control_strings_only_stand_where_the_template_put_them(spark):
    texts = ["".join(p) for p in itertools.product(["<", "</", "\\", "s>", "[", "INST]"], repeat=4)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    assert df.where(F.regexp_like("e", F.lit(chat.CONTROL))).isEmpty()
    assert df.where(chat.unescape(F.col("e")) != F.col("t")).isEmpty()
    assert df.select("e").distinct().count() == len(set(texts))


def test_layouts_are_told_apart_by_their_paths(spark):
    schema = T.StructType([*chat.RECORD, T.StructField("extra", T.StringType())])
    none = dict.fromkeys(schema.names)
    cases = [
        ({"prompt": "p", "completion": "c"}, "prompt", [("user", "p"), ("assistant", "c")]),
        ({"prompt": "p", "completion": "c", "system": "s", "extra": "x"}, "prompt", [("system", "s"), ("user", "p"), ("assistant", "c")]),
        ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
        ({"instruction": "i", "input": "n", "output": ""}, "instruction", [("user", "i"), ("user", "n"), ("assistant", "")]),
        ({"conversations": [("human", "h"), ("GPT", None), ("system", "s")]}, "conversations", [("user", "h"), ("assistant", ""), ("system", "s")]),
        ({"messages": []}, "messages", []),
        ({"prompt": "p"}, None, None),
        ({"prompt": "p", "completion": "c", "output": "o"}, None, None),
        ({}, None, None),
    ]
    df = spark.createDataFrame([tuple((none | fields).values()) for fields, _, _ in cases], schema)
    got = chat.format_records(df).select("layout", "turns", "formatted").collect()
    assert [r.layout for r in got] == [layout for _, layout, _ in cases]
    assert [r.turns and [tuple(t) for t in r.turns] for r in got] == [turns for _, _, turns in cases]
    assert [r.formatted is None for r in got] == [layout is None for _, layout, _ in cases]


def test_nested_fields_have_paths():
    schema = T.StructType().add("a", T.StructType().add("b", "string").add("c", "string")).add("d", "string")
    assert set(chat.leaf_paths(schema)) == {"a.b", "a.c", "d"}


def test_rows_without_conversation_stay_alone(spark):
    rows = [(1, 1, "user", "b"), (1, 0, "user", "z"), (1, 0, "user", "a"), (None, 0, "user", "x"), (None, 1, None, None)]
    out = chat.conversations_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = sorted(([i["text"] for i in r["items"]] for r in out.collect()), key=repr)
    assert got == [[""], ["a", "z", "b"], ["x"]]


PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>two</p>"), (3, "http://c/\r\nX: y", "<p>one</p>"),
    (0, None, "<p>two</p>"), (4, "", None), (5, "http://e/", ""), (None, "http://f/", "<p>one</p>"),
    (6, "http://g/", "WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n" * 50), (7, "http://h/", "é" * 70_000),
    (8, "http://h/", "é" * 70_000), (9, "http://i/", "same"), (9, "http://i/", "same"), (-3, "http://j/", "minus"),
]
PAGE_SCHEMA = "page_id long, url string, html string, warc_type string, digest string"


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "pages")
    spark.createDataFrame([(*p, "a", "b") for p in PAGES], PAGE_SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_archives_come_back(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "w"), segment_bytes=1000, chunk_bytes=77, records_per_archive=5)
    back = warc.resolve_revisits(warc.read_warc(spark, str(tmp_path / "w"))).collect()
    assert len(back) == len(PAGES) and all(r.error is None for r in back)
    want = {}
    for page_id, _, html in PAGES:
        want.setdefault(html or "", []).append(page_id)
    for payload, ids in want.items():
        group = [r for r in back if r.payload_digest == warc.payload_digest(payload.encode())]
        first = min((i for i in ids if i is not None), default=None)
        assert sorted(r.page_id is None and 99 or r.page_id for r in group) == sorted(i is None and 99 or i for i in ids)
        assert [(r.page_id, bytes(r.payload).decode()) for r in group if r.warc_type == "response"] == [(first, payload)]
        assert all(r.refers_to_page == first and r.payload is None for r in group if r.warc_type == "revisit")
        assert {r.payload_bytes for r in group} == {len(payload.encode())}


def test_small_payloads_need_no_revisit(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "w"), min_payload=1000)
    back = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert [r.page_id for r in back if r.warc_type == "revisit"] == [8]
    assert len(back) == len(PAGES) and all(r.error is None for r in back)


def test_archives_are_warc(spark, pages, tmp_path):
    warc.write_warc(pages, str(tmp_path / "w"), segment_bytes=1000, records_per_archive=4)
    files = sorted((tmp_path / "w").glob("part-*.gz"))
    assert len(files) > 3
    for file in files:
        data = gzip.decompress(file.read_bytes())
        while data:
            assert data.startswith(b"WARC/1.1\r\n")
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            length = int(fields[b"Content-Length"])
            assert length <= 1000 and rest[length : length + 4] == b"\r\n\r\n"
            data = rest[length + 4 :]


def test_broken_segments_are_reported(spark, tmp_path):
    def record(n, block, total=None, origin="<o>"):
        fields = [("WARC-Type", "response" if n == 1 else "continuation"), ("WARC-Record-ID", origin if n == 1 else f"<{origin}{n}>")]
        fields.append(("WARC-Segment-Number", str(n)))
        if n > 1:
            fields.append(("WARC-Segment-Origin-ID", origin))
        if total is not None:
            fields.append(("WARC-Segment-Total-Length", str(total)))
        return warc.record_bytes(fields, block) + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    whole = http + warc.chunked(b"payload", 3)
    a, b = whole[:40], whole[40:]
    cases = {
        "<good>": [(2, b, len(whole)), (1, a, None)],
        "<gap>": [(1, a, None), (3, b, len(whole))],
        "<twice>": [(1, a, None), (2, b, len(whole)), (2, b, len(whole))],
        "<short>": [(1, a, None), (2, b, len(whole) + 1)],
        "<open>": [(1, a, None), (2, b, None)],
        "<orphan>": [(2, b, len(whole))],
        "<chunks>": [(1, http + b"5\r\nab", None), (2, b"c\r\n", len(http) + 8)],
    }
    folder = tmp_path / "w"
    folder.mkdir()
    records = [record(*part, origin=o) for o, parts in cases.items() for part in parts]
    (folder / "part-0.gz").write_bytes(b"".join(gzip.compress(r) for r in records[::2]))
    (folder / "part-1").write_bytes(b"junk\r\n" + b"".join(records[1::2]))
    got = {r.record_id: r for r in warc.read_warc(spark, str(folder)).collect()}
    assert bytes(got["<good>"].payload) == b"payload" and got["<good>"].error is None
    assert all(r.error for i, r in got.items() if i != "<good>")
    assert set(got) == set(cases) - {"<orphan>"} | {None}
    assert "total length" in got["<short>"].error and "last segment" in got["<open>"].error


def test_empty_archives(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], PAGE_SCHEMA), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).isEmpty()


def test_digest_is_base32_sha1():
    import base64

    assert base64.b32decode(warc.payload_digest(b"abc")) == hashlib.sha1(b"abc").digest()


def vectors():
    import random

    rng = random.Random(5)
    rows = [(n, [rng.uniform(-1, 1) for _ in range(8)]) for n in range(300)]
    rows += [(n, [0.5] * 8) for n in range(300, 420)]
    rows += [(50, [0.5] * 8), (50, [0.5] * 8), (None, [0.9] * 8), (None, [0.5] * 8), (-50, [0.25] * 8)]
    rows += [(450, None), (451, []), (452, [None] * 8), (453, [float("nan")] * 8), (454, [float("inf")] + [0.0] * 7)]
    rows += [(500, [0.1] * 3), (501, [0.2] * 3), (550, [0.3] * 5), (600, [1e6] * 8), (601, [-1e6] * 8)]
    return rows


@pytest.mark.parametrize(("pivots", "group", "block"), [(64, 512, 2048), (4, 3, 10), (1, 1, 1000)])
def test_top_k_equals_brute_force(spark, monkeypatch, pivots, group, block):
    monkeypatch.setattr(knn, "GROUP", group)
    monkeypatch.setattr(knn, "BLOCK", block)
    rows = vectors()
    df = spark.createDataFrame([(*r, 0.0) for r in rows], "vec_id long, embedding array<double>, distance double")
    got = sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in knn.top_k(df, F.col("vec_id") % 50 == 0, pivots=pivots).collect()), key=repr)
    assert got == sorted(brute.top_k(rows), key=repr)


def test_products_are_exact_or_saturate():
    a = np.array([[2**40 + 1, 3], [2**62, 2**62]])
    assert knn.exact_products(a[:1], np.array([[2**20, 1]])).tolist() == [[(2**40 + 1) * 2**20 + 3]]
    assert knn.exact_products(a[1:], np.array([[4, 4], [-4, -4]])).tolist() == [[2**63 - 1, -(2**63)]]


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert knn.top_k(empty, F.col("vec_id") % 50 == 0).isEmpty()
    no_query = spark.createDataFrame([(1, [1.0]), (2, None)], "vec_id long, embedding array<float>")
    assert knn.top_k(no_query, F.col("vec_id") % 50 == 0).isEmpty()


def test_components(spark):
    edges = [(n, n + 1) for n in range(40) if n not in (10, 25)] + [(7, 7), (3, 2), (3, 2), (100, 101)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.component, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(11)), list(range(11, 26)), list(range(26, 41)), [100, 101]]
    assert all(c in g for c, g in groups.items())
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).isEmpty()


def test_a_query_that_is_a_pivot_finds_all_its_best(spark):
    # cells hold one vector each, so the bounds are the scores themselves
    vectors = spark.createDataFrame([(n, [float(10 - n), float(n * n % 7)]) for n in range(10)], "vec_id long, embedding array<double>")
    found = knn.top_k(vectors, F.col("vec_id") == 0).collect()
    scores = sorted(((10 - n) * 10 * 2**16, -n) for n in range(1, 10))[::-1][:5]
    assert sorted((r["rank"], r.vec_id, r.score) for r in found) == [(p + 1, -n, s) for p, (s, n) in enumerate(scores)]


def test_pivots_grow_with_the_rows_and_few_rings_are_sent(spark, monkeypatch):
    # 40 far clusters; the best partners of a query lie in its own
    centre = lambda n: [400.0 if d == n % 40 else 0.0 for d in range(40)]
    data = [(n, [c + (n * 31 % 97 + d) % 5 / 10 for d, c in enumerate(centre(n))]) for n in range(6_000)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    plans, real = [], knn.stored

    def kept(df, name):
        out = real(df, name)
        if name == "knn-plan":
            plans.append(out)
        return out

    monkeypatch.setattr(knn, "stored", kept)
    monkeypatch.setattr(knn, "GROUP", 8)
    found = knn.top_k(vectors, F.col("vec_id") % 50 == 0)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found.collect()}
    v = np.floor(256 * np.array([x for _, x in data])).astype(np.int64)
    for q in range(0, 6_000, 50):
        scores = v @ v[q]
        best = sorted((-int(s), n) for n, s in enumerate(scores) if n != q)[:5]
        assert [got[(q, p + 1)] for p in range(5)] == [(n, -s) for s, n in best]
    groups = plans[0].select("group").distinct().count()
    assert plans[0].count() < groups * 77 * knn.RINGS / 2  # 77 pivots; sent everywhere, it would be all of their rings
