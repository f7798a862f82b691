import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.sources import conll, files


def test_conll_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, ["EU", "rejects", "it"], ["B-ORG", "O", "O"]), (2, ["Peter"], ["B-PER"])],
                               "id int, tokens array<string>, tags array<string>")
    path = str(tmp_path / "c")
    conll.write_conll(df.orderBy("id"), path)
    back = sorted((r["tokens"], r["tags"]) for r in conll.read_conll(spark, path).collect())
    assert back == [(["EU", "rejects", "it"], ["B-ORG", "O", "O"]), (["Peter"], ["B-PER"])]


def test_conll_group_reader(spark, tmp_path):
    p = tmp_path / "g.txt"
    # The header names every column, the token column included.
    p.write_text("[token] [ent] [arg]\n-- skipped --\nA B-X 1\nb O True\nc Я O\nd O O O O O O\n\nE I-X 0\n",
                 encoding="utf-8")
    got = sorted((r["tokens"], r["tags"]) for r in conll.read_conll_group(spark, str(p), "arg").collect())
    assert got == [(["A", "b", "c"], ["1", "1", "O"]), (["E"], ["0"])]
    got = sorted((r["tokens"], r["tags"]) for r in conll.read_conll_group(spark, str(p), "ent").collect())
    assert got == [(["A", "b", "c"], ["B-X", "O", "O"]), (["E"], ["I-X"])]


def test_csv_quoting(spark, tmp_path):
    df = spark.createDataFrame([('a, "quoted"\nline', 1), ("plain", 0)], "text string, label int")
    path = str(tmp_path / "csv")
    files.write_labelled_csv(df, path)
    back = files.read_labelled_csv(spark, path, "text string, label int", header=True)
    assert sorted(back.collect()) == sorted(df.collect())


def test_lines_and_files(spark, tmp_path):
    d = tmp_path / "d"
    d.mkdir()
    (d / "a.txt").write_text(" one \ntwo\n", encoding="utf-8")
    assert sorted(r["line"] for r in files.read_lines(spark, str(d)).collect()) == ["one", "two"]
    assert files.read_files(spark, str(d)).select(F.length("text")).first()[0] == 10


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _files(folder):
    """Files with LF and CRLF, padded and repeated blank lines, a missing last line end, and an empty file."""
    r = random.Random(3)
    want = {}
    for n, (eol, blanks) in enumerate([("\n", ["\n"]), ("\r\n", ["\r\n"]), ("\n", [" \t\n", "\n\n", "\n \n\n"]), ("\r\n", ["  \r\n", "\r\n\r\n"])]):
        sents = [[f"f{n}s{s}w{w} -X- _ {r.choice(['O', 'B-A', 'I-A'])}" for w in range(r.randrange(1, 9))] for s in range(40)]
        text = "".join(eol.join(x) + eol + r.choice(blanks) for x in sents)
        (folder / f"part-{n}.txt").write_bytes((text.rstrip() if n % 2 else text).encode())
        want[f"part-{n}.txt"] = sents
    (folder / "part-9.txt").write_bytes(b"")
    return want


def test_lines_are_numbered_in_file_order(spark, tmp_path, small_blocks):
    (tmp_path / "a.txt").write_text("".join(f"line {k}\n" for k in range(300)), encoding="utf-8")
    (tmp_path / "b.txt").write_bytes(b"x\r\n\r\ny")
    got = sorted((r["file"].rsplit("/")[-1], r["line_no"], r["value"]) for r in conll.numbered_lines(spark, str(tmp_path)).collect())
    assert got == sorted([("a.txt", k, f"line {k}") for k in range(300)] + [("b.txt", 0, "x"), ("b.txt", 1, ""), ("b.txt", 2, "y")])


def test_sentences_across_blocks_and_separators(spark, tmp_path, small_blocks):
    want = _files(tmp_path)
    back = conll.file_ordinal(conll.read_conll(spark, str(tmp_path))).collect()
    got = {}
    for r in sorted(back, key=lambda r: r["ordinal"]):
        got.setdefault(r["file"].rsplit("/")[-1], []).append([f"{t} -X- _ {g}" for t, g in zip(r["tokens"], r["tags"])])
    assert got == want
    assert sorted(r["ordinal"] for r in back) == list(range(160))
    assert all(r["rec"] == r["ordinal"] % 40 for r in back)


def test_each_file_has_its_own_header(spark, tmp_path, small_blocks):
    body = lambda order: "".join(" ".join([f"t{k}", *(f"{c}{k}" for c in order)]) + ("\n\n" if k % 3 == 2 else "\n") for k in range(60))
    (tmp_path / "a.conll").write_text("[token] [ent] [arg]\n-- x --\n" + body("ea"), encoding="utf-8")
    (tmp_path / "b.conll").write_bytes(("[token] [arg] [ent]\r\n-- x --\r\n" + body("ae").replace("\n", "\r\n")).encode())
    (tmp_path / "c.conll").write_text("[token] [other]\n-- x --\nt0 z0\n", encoding="utf-8")
    got = conll.read_conll_group(spark, str(tmp_path), "arg").collect()
    assert len(got) == 40 and {r["file"][-7] for r in got} == {"a", "b"}
    for r in got:
        assert r["tokens"] == [f"t{3 * r['rec'] + k}" for k in range(3)] and r["tags"] == [f"a{3 * r['rec'] + k}" for k in range(3)]


def test_json_stats(spark, tmp_path):
    path = str(tmp_path / "stats")
    files.write_json_stats(spark.createDataFrame([("train", 70), ("test", 30)], "split string, n long"), path)
    assert sorted(map(tuple, spark.read.json(path).select("split", "n").collect())) == [("test", 30), ("train", 70)]


def test_lines_are_not_shuffled(spark, tmp_path):
    """Only rows of blocks, and of sentences that a block's end cuts, meet in joins."""
    _files(tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = conll.numbered_lines(spark, str(tmp_path))
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (lines, conll.file_ordinal(conll.read_conll(spark, str(tmp_path))))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not any("SortMergeJoin" in p for p in plans)


def test_batched_map_bounds_a_frame(spark):
    from tessera.operators import udf

    seen = udf.batched_map(spark.range(5000).coalesce(1), lambda b: b.assign(n=len(b)), "id long, n long").collect()
    assert sorted(r["id"] for r in seen) == list(range(5000)) and max(r["n"] for r in seen) <= udf.ROWS


def test_files_of_groups_are_read_once(spark, tmp_path):
    """Headers, numbers and sentences come from one pass over the lines."""
    (tmp_path / "a.conll").write_text("[token] [ent]\n-- x --\na b\n", encoding="utf-8")
    got = conll.file_ordinal(conll.read_conll_group(spark, str(tmp_path), "ent"))
    assert "FileScan text" not in got._jdf.queryExecution().executedPlan().toString() and got.first()["tags"] == ["b"]


def test_headers_that_blocks_cut(spark, tmp_path):
    """Blocks smaller than a line: the lines that are skipped lie in several, and a sentence may follow them at once."""
    w = lambda c: c * 300
    long = lambda text: "".join(w(c) if c.isalpha() or c == "-" else c for c in text)
    (tmp_path / "a").write_text(long("[t] [x]\n\nq Q\nr R\n\ns S s s s s\n\nu U"), encoding="utf-8")
    (tmp_path / "b").write_text(long("[x] [t]\n-- --\n\n \nv V\n"), encoding="utf-8")
    (tmp_path / "c").write_text(long("[t] [x]"), encoding="utf-8")
    for size in ("500", "900"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            df = conll.read_conll_group(spark, str(tmp_path), w("x"))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        got = sorted((r["file"][-1], r["rec"], [t[0] for t in r["tokens"]], [t[0] for t in r["tags"]]) for r in df.collect())
        assert got == [("a", 0, ["q", "r"], ["Q", "R"]), ("a", 2, ["u"], ["U"]), ("b", 0, ["v"], ["v"])]


def test_runs_of_lines_however_batches_cut_them():
    r = random.Random(5)
    for _ in range(60):
        rows = [(f, b, v) for f in "ab" for b in (0, 7, 9)[: r.randrange(1, 4)] for v in r.choices(["x", "y", "", " "], k=r.randrange(1, 9))]
        want, last, k = [], None, 0
        for n, (f, b, v) in enumerate(rows):
            if (f, b) != last:
                own = [x for x in rows if x[:2] == (f, b)]
                want.append((f, b, -1, 0, len(own), [v]))
                last, k, at = (f, b), 0, n
            if v.strip():
                if n > at and rows[n - 1][2].strip():
                    want[-1][-1].append(v)
                    want[-1] = (*want[-1][:4], want[-1][4] + 1, want[-1][5])
                else:
                    want.append((f, b, k, n - at, 1, [v]))
                    k += 1
        table = pa.table({"file": [x[0] for x in rows], "block": pa.array([x[1] for x in rows], pa.int64()), "value": [x[2] for x in rows],
                          "blank": [not x[2].strip() for x in rows]}).combine_chunks().to_batches()[0]
        cuts = sorted({0, len(rows), *(r.randrange(len(rows)) for _ in range(r.randrange(6)))})
        got = [tuple(x.values()) for b in conll._gather(iter([table.slice(i, j - i) for i, j in zip(cuts, cuts[1:])])) for x in b.to_pylist()]
        assert sorted(got) == sorted(want)
