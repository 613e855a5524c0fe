import os

import pytest
from pyspark.sql import functions as F

from contentlake.sources import csv_split, doctree, tables
from contentlake.streaming.feedback import read_feedback, run_feedback_stream

FILES = {
    "_index.md": "top", "a/_INDEX.md": "idx", "a/b.md": "x\r\ny\rz", "a/c.MD": "upper", "a/.hidden.md": "h",
    "a/d.txt": "no", "deep/er/still/e.md": "é", "bad.md": b"\xff\xfe\xfa",
}


def make_tree(root):
    for name, text in FILES.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())


def names(df, root):
    return sorted(os.path.relpath(r["path"], root) for r in df.collect())


def test_read_doc_tree(spark, tmp_path):
    make_tree(tmp_path)
    docs = {os.path.relpath(r["path"], tmp_path): r for r in doctree.read_doc_tree(spark, str(tmp_path)).collect()}
    assert set(docs) == {n for n in FILES if n.lower().endswith(".md")}
    assert docs["a/b.md"]["content"] == "x\ny\nz" and docs["deep/er/still/e.md"]["content"] == "é"
    assert docs["bad.md"]["content"] is None and "Error reading" in docs["bad.md"]["error"]


def test_tree_options(spark, tmp_path):
    make_tree(tmp_path)
    exact = doctree.read_doc_tree(spark, str(tmp_path), ignore_case=False, skip_index="exact", tasks=2)
    assert names(exact, tmp_path) == ["a/.hidden.md", "a/_INDEX.md", "a/b.md", "bad.md", "deep/er/still/e.md"]
    any_case = doctree.read_doc_tree(spark, "file://" + str(tmp_path), skip_index="any")
    assert "a/_INDEX.md" not in names(any_case, tmp_path)
    few = doctree.list_files(spark, str(tmp_path), folders=1)
    assert few.count() == len(FILES)


def test_write_doc_tree(spark, tmp_path):
    docs = spark.createDataFrame([("x/y.md", "a\nb"), ("/z.md", "é"), ("n.md", None)], "path string, content string")
    docs = docs.union(spark.createDataFrame([("../up.md", "x"), ("a/../../up.md", "x"), (None, "x"), ("..a/b.md", "fine")], docs.schema))
    left = doctree.write_doc_tree(docs, str(tmp_path / "out")).collect()
    assert sorted((str(r["path"]), r["reason"]) for r in left) == [
        ("../up.md", "path leaves the root"), ("None", "path leaves the root"), ("a/../../up.md", "path leaves the root"), ("n.md", "no text")]
    assert (tmp_path / "out/x/y.md").read_text() == "a\nb" and (tmp_path / "out/z.md").read_text() == "é"
    assert not (tmp_path / "out/n.md").exists() and (tmp_path / "out/..a/b.md").read_text() == "fine"
    assert not (tmp_path / "up.md").exists()


def test_xml_in_its_declared_encoding(spark, tmp_path):
    folder = tmp_path / "xml" / "ru" / "docs"
    folder.mkdir(parents=True)
    (folder / "k.xml").write_bytes('<?xml version="1.0" encoding="koi8-r"?><article name="Привет"/>'.encode("koi8-r"))
    (folder / "u.xml").write_bytes('<?xml version="1.0" encoding="utf-16"?><article name="Ж"/>'.encode("utf-16"))
    (folder / "bad.xml").write_bytes(b'<?xml version="1.0" encoding="nope"?><article name="x"/>')
    from contentlake.functions.markup import xml_title

    docs = doctree.read_xml_docs(spark, str(tmp_path), ["ru"])
    got = {r["path"].rpartition("/")[2]: (r["title"], r["error"]) for r in docs.select("path", xml_title("xml").alias("title"), "error").collect()}
    assert got["k.xml"] == ("Привет", None) and got["u.xml"] == ("Ж", None)
    assert got["bad.xml"][0] == "" and "nope" in got["bad.xml"][1]


def test_read_xml_docs(spark, tmp_path):
    for lang in ("en", "zz"):
        (tmp_path / "xml" / lang / "docs" / "sub").mkdir(parents=True)
        (tmp_path / "xml" / lang / "docs" / "sub" / "a.XML").write_text("<a/>")
    got = doctree.read_xml_docs(spark, str(tmp_path), ["en", "ru"]).collect()
    assert [(r["path"], r["lang"], r["xml"]) for r in got] == [("xml/en/docs/sub/a.XML", "en", "<a/>")]


def test_lookup_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text("filepath, url\n/a/, https://h/a/\n/b/ ,https://h/b\n, https://h/none\n/a/, https://h/late//\n/c/,\n")
    rules = tables.read_lookup_csv(spark, str(tmp_path / "m.csv")).orderBy("ord").collect()
    assert [(r["prefix"], r["target"]) for r in rules] == [("/a/", "https://h/late"), ("/b/", "https://h/b")]


def test_survey_files(spark, tmp_path):
    label = tmp_path / "label.csv"
    label.write_text('ResponseId,Q2\nResponse ID,Any suggestions for improvement?\nr1,"two\nlines"\nr2,Any suggestions for improvement?\n')
    assert [r["ResponseId"] for r in tables.read_survey(spark, str(label)).orderBy("row_order").collect()] == ["r1", "r2"]
    twice = tmp_path / "twice.csv"
    twice.write_text("ResponseId,Q2\nResponseId,Q2\nr1,x\nResponseId,Q2\n")
    assert [r["ResponseId"] for r in tables.read_survey(spark, str(twice)).orderBy("row_order").collect()] == ["r1", "ResponseId"]
    export = tmp_path / "export.csv"
    export.write_text('A,B\nLabel A,Label B\n"{""ImportId"":""x""}",y\nr1,ImportId\n')
    assert [r["A"] for r in tables.read_survey_export(spark, str(export)).orderBy("row_order").collect()] == ["Label A", "r1"]


def test_id_and_config_lists(spark, tmp_path):
    (tmp_path / "ids.txt").write_text(" a \n\nb\na\n")
    assert sorted(r["id"] for r in tables.read_id_list(spark, str(tmp_path / "ids.txt")).collect()) == ["a", "b"]
    (tmp_path / "x.conf").write_text("one\r\n\ntwo")
    lines = tables.read_config_lines(spark, str(tmp_path / "x.conf")).orderBy("line_no").collect()
    assert [r["line"] for r in lines] == ["one", "", "two"]
    assert tables.read_config_lines(spark, str(tmp_path / "absent.conf")).count() == 0


def test_row_order_over_many_splits(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.conf").write_text("".join(f"{i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = tables.read_config_lines(spark, str(tmp_path / "*.conf"))
        assert lines.rdd.getNumPartitions() > 10
        for r in lines.groupBy("file_id").agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("l")).collect():
            assert [int(x["line"]) for x in r["l"]] == list(range(3000))
            assert len({x["line_no"] for x in r["l"]}) == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, 'a "q", b\nc'), (1, None), (3, "")], "n int, t string")
    tables.write_report(df, str(tmp_path / "r"), ["t", "n"], ["n"])
    back = tables.read_report(spark, str(tmp_path / "r"), "t string, n int")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted([(r["t"], r["n"]) for r in df.collect()], key=repr)


def test_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "lang string, n int")
    tables.write_partitioned(df, str(tmp_path / "p"), "lang")
    assert sorted(d for d in os.listdir(tmp_path / "p") if d.startswith("lang")) == ["lang=a", "lang=b"]


def test_section_label(apply):
    assert apply(["x" * 40, "short"], lambda c: tables.section_label(F.col(c))) == ["x" * 31, "short"]


def test_stream_is_incremental_and_drops_repeats(spark, tmp_path):
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "row_id long, response_id string, link_url string, q1 double, q2 string, start_date string"

    products = spark.createDataFrame([(1, "https://h/", "All")], "ord int, prefix string, target string")

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        run_feedback_stream(spark.readStream.schema(schema).parquet(landing), target, origin="https://h", products=products, exclude=spark.createDataFrame([("zz",)], "id string"))
        return {r["canonical_url"]: r for r in read_feedback(spark, target).collect()}

    first = arrive([(1, "a", "/x", 1.0, "one", "2024-01-01"), (2, "b", "/x", 2.0, "testing", "2024-01-01"), (3, "c", None, 2.0, "n", "2024-01-01"), (9, "zz", "/x", 5.0, "out", "2024-01-01")])
    assert first["https://h/x/"]["n"] == 1 and first["https://h/x/"]["product"] == "All"
    second = arrive([(4, "d", "/x?q", 2.0, "mail a@b.c", "2023-01-01"), (1, "a", "/x", 1.0, "one", "2024-01-01")])
    assert (second["https://h/x/"]["n"], second["https://h/x/"]["avg_q1"]) == (2, 1.5)
    assert second["https://h/x/"]["q2_comments"] == "one|||mail"


# --- CSV with line breaks in splits ------------------------------------------------------------------------


def _odd_files(folder, n=400):
    """Files of different line ends whose cells hold quotes, separators, line breaks and blanks; plus stray quotes and short rows."""
    import csv
    import random

    rng = random.Random(3)

    def cell():
        if rng.random() < 0.4:
            return "".join(rng.choice(["a", "b", " ", '"', ",", "\n", '""', "\r\n", "é", "x,y"]) for _ in range(rng.randrange(0, 30)))
        return rng.choice(["", "w" + str(rng.randrange(1000))])

    folder.mkdir()
    for f, end in enumerate(["\n", "\r\n", "\n"]):
        with open(folder / f"f{f}.csv", "w", newline="", encoding="utf-8") as h:
            w = csv.writer(h, lineterminator=end)
            w.writerow(["Response ID", "a`b", "c"])
            w.writerows([f"r{f}-{i}", cell(), cell()] for i in range(n))
            if f == 0:
                h.write('r0-x,5" pipe,"q" tail\n\nr0-y,only\n')
            if f == 2:
                h.write("r2-long,\"" + "line\n" * 2000 + '",end')  # a record over many blocks, without a last line feed
    return str(folder)


@pytest.mark.parametrize("split", ["128m", "700"])
def test_split_csv_equals_the_multi_line_reader(spark, tmp_path, split):
    path = _odd_files(tmp_path / "csv")
    want = sorted(str(tuple(r)) for r in spark.read.csv(path, header=True, multiLine=True, escape='"').collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        read = csv_split.read_split_csv(spark, path)
        got = read.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert read.columns == ["Response ID", "a`b", "c", "file", "split_start", "row_order", "ordinal"]
    assert sorted(str(tuple(r)[:3]) for r in got) == want
    blocks = len({(r["file"], r["split_start"]) for r in got})
    assert blocks == 3 if split == "128m" else blocks > 50
    ordered = sorted(got, key=lambda r: (r["file"], r["row_order"]))
    assert [r[0] for r in ordered if r[0].startswith("r1-")] == [f"r1-{i}" for i in range(400)]
    assert {r[0]: r["ordinal"] for r in got if r["ordinal"] is not None} == {f"r{f}-{i}": i for f in range(3) for i in range(2)}


@pytest.mark.parametrize(
    "line,inside,after",
    [('a,b', False, False), ('a,b', True, True), ('"a', False, True), ('a"', True, False), ('a""b', True, True), ('a"",', True, True), ('a"x",b', True, False), ('5" x', False, False), ('a,"', False, True), ('"",""', False, False), ('","', True, True), ('"a"b,"c', False, True), ("", True, True)],
)
def test_state_of_a_line(line, inside, after):
    assert csv_split.ends_inside(line, inside) is after
