"""Parsers and normalisers on nulls, empty texts and malformed input."""

from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.sources import parsers


def test_timed_text(spark):
    rows = [(1, '<t><text start="0" dur="1.5">a &amp; b</text><text start="2">c</text></t>'), (2, "<t/>"), (3, ""), (4, None), (5, "<t><text")]
    got = parsers.timed_text(spark.createDataFrame(rows, "id int, xml string"), "xml", "id").collect()
    assert sorted(map(tuple, got)) == [(1, 0.0, 1.5, "a & b"), (1, 2.0, None, "c")]


def test_variants(spark):
    text = "#EXTM3U\r\n#EXT-X-STREAM-INF:AVERAGE-BANDWIDTH=9,RESOLUTION=4x720\r\nhi\n#EXT-X-STREAM-INF:BANDWIDTH=3\nbare\n#EXT-X-STREAM-INF:AVERAGE-BANDWIDTH=5,RESOLUTION=4x480\nlow\n#EXT-X-STREAM-INF:X"
    found = parsers.variants(spark.createDataFrame([(1, text), (2, ""), (3, None)], "id int, p string"), "p", "id")
    assert sorted(map(tuple, found.collect())) == sorted([(1, "hi", 9, 720), (1, "bare", None, None), (1, "low", 5, 480)])
    assert [tuple(r) for r in parsers.lightest(found, "id", 720).collect()] == [(1, "low", 5, 480)]


def test_balanced_json(spark):
    rows = ['x = {"a": "}\\"{", "b": {}} tail', "x = {", "x =", "{}", "", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    got = [r.j for r in df.select("i", parsers.balanced_json(F.col("t"), "x =").alias("j")).orderBy("i").collect()]
    assert got == ['{"a": "}\\"{", "b": {}}', None, None, None, None, None]


def test_repair(spark):
    rows = ["Ã©tÃ©", "été", "Â", "Ã€ — x", "", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    got = [r.t for r in df.select("i", T.repair(F.col("t")).alias("t")).orderBy("i").collect()]
    assert got == ["été", "été", "Â", "Ã€ — x", "", None]


def test_canonical(spark):
    rows = [(0, ["b", "x", "a", "b", None]), (1, []), (2, ["x", "x"])]
    df = spark.createDataFrame(rows, "i int, n array<string>")
    got = [(r.c.themes, r.c.rest) for r in df.select("i", T.canonical(F.col("n"), {"a": "A", "b": "B"}, "D").alias("c")).orderBy("i").collect()]
    assert got == [(["B", "A"], ["x"]), (["D"], []), (["D"], ["x"])]


def test_dossiers(spark):
    head, block = '{"record_type":"header","columns":["a","b"]}', '{"record_type":"transcript_block","value":[["1"],["2","x","y"]]}'
    foot = '{"record_type":"footer","count":2,"checksum":%d}'
    import zlib

    total = zlib.crc32(f"0:{head}".encode()) + zlib.crc32(f"1:{block}".encode())
    rows = [(k, i, x) for k, lines in {1: [head, block, foot % total], 2: [head, block, foot % 7], 3: [head, foot % 7], 4: [block], 5: [head, block], 6: ["{", None]}.items() for i, x in enumerate(lines)]
    states, found = parsers.dossiers(spark.createDataFrame(rows, "k int, n int, line string"), "k", "n", "line")
    assert sorted(map(tuple, states.collect())) == [(1, "ok"), (2, "checksum"), (3, "count"), (4, "no_header"), (5, "no_footer"), (6, "no_header")]
    assert sorted((r.row["a"], r.row["b"]) for r in found.filter("k = 1").collect()) == [("1", None), ("2", "x")]


def test_without_sections(spark):
    rows = ["", None, "## Drop me!\nx\n", "t\n## keep\ny ins-1\n## DROP  me\nz", "## drop me"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    got = [r.t for r in df.select("i", parsers.without_sections(F.col("t"), ["drop me"], "ins-[0-9]").alias("t")).orderBy("i").collect()]
    assert got == ["", None, "", "t\n## keep\ny [source-ref]", ""]


def test_artefacts(spark):
    rows = ["vid?o", "ok? Yes", "what?", "a??b �", "", None, "Edio, vocs_"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    got = [([tuple(x) for x in r.c], r.b) for r in df.select("i", T.artefact_contexts(F.col("t"), 2).alias("c"), T.broken_words(F.col("t")).alias("b")).orderBy("i").collect()]
    orphan, lost = "orphan_question_mark", "replacement_character"
    assert got == [([(orphan, "vid?o")], []), ([], []), ([], []), ([(orphan, "a??b �"), (lost, "b �")], []), ([], []), ([], []), ([], ["edio"])]
