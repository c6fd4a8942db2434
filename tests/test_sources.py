import csv
import io
import random
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.sources import delimited as L
from basketry.sources import records as R
from basketry.sources.tables import StalePublish, TableStore, create_once, read_text
from basketry.specs import CUSTOMER


@pytest.fixture
def folder(tmp_path):
    return tmp_path


def write(path, text, encoding):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_encodings_are_told_apart(spark, folder):
    cp = write(folder / "a.csv", "id;name\n1;Café €\n", "cp1252")
    utf = write(folder / "b.csv", "id;name\n1;Café €\n", "utf-8")
    bom = write(folder / "c.csv", "id;name\n1;Café €\n", "utf-8-sig")
    assert L.detect_encoding(spark, cp, ["utf-8", "cp1252"]) == "cp1252"
    assert L.detect_encoding(spark, utf, ["utf-8", "cp1252"]) == "utf-8"
    for path in (cp, utf, bom):
        df = L.scan_delimited(spark, path)
        assert df.columns == ["id", "name"]
        assert df.collect()[0].name == "Café €"


def test_bytes_undefined_in_cp1252_fall_back(spark, folder):
    path = folder / "d.csv"
    path.write_bytes("id;name\n1;".encode() + "Ý".encode() + b"\n")  # C3 9D: 9D is undefined in cp1252
    assert L.detect_encoding(spark, str(path), ["cp1252", "utf-8"]) == "utf-8"


def test_long_lines_are_skipped_and_short_ones_padded(spark, folder):
    text = 'id;name;v\n1;a;x\n2;b\n3;c;y;\n4;d;z;q\n5;e;;;w\n6;"f;g";u\n7;NA;null\n'
    df = L.scan_delimited(spark, write(folder / "e.csv", text, "utf-8"))
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("1", "a", "x"), ("2", "b", None), ("6", "f;g", "u"), ("7", None, None)]
    assert sorted(r.id for r in df.select("id").collect()) == ["1", "2", "6", "7"]
    assert df.count() == 4


def test_quoted_fields(spark, folder):
    text = 'id;"na""me; x"\n1;"He said ""hi"" ok"\n2;"semi ""x;y"" z"\n3;"C:\\dir\\"\n4;"a";"b"\n5;C:\\x\n'
    df = L.scan_delimited(spark, write(folder / "q.csv", text, "utf-8"))
    assert df.columns == ["id", 'na"me; x']
    assert dict(tuple(r) for r in df.collect()) == {
        "1": 'He said "hi" ok', "2": 'semi "x;y" z', "3": "C:\\dir\\", "5": "C:\\x",
    }


def test_line_breaks_in_quotes(spark, folder):
    text = 'id;v\n1;"a\nb"\n2;"c ""d""\n;e"\n3;f;g\n4;h\n'
    df = L.scan_delimited(spark, write(folder / "m.csv", text, "utf-8"))
    assert dict(tuple(r) for r in df.collect()) == {"1": "a\nb", "2": 'c "d"\n;e', "4": "h"}


def test_header_under_the_encoding(spark, folder):
    path = write(folder / "h.csv", "id;libellé €\n1;é\n", "cp1252")
    assert L.scan_delimited(spark, path).columns == ["id", "libellé €"]


def test_round_trip_of_awkward_fields(spark, folder):
    rows = [("1", 'He said "hi"'), ("2", 'semi "x;y" z'), ("3", "C:\\dir\\"), ("4", '"'), ("5", "\\"), ("6", '\\";')]
    df = spark.createDataFrame(rows, 'id string, `na"me` string')
    L.write_delimited(df, str(folder / "awkward"))
    back = L.scan_delimited(spark, str(folder / "awkward"))
    assert back.columns == df.columns and sorted(tuple(r) for r in back.collect()) == rows


def test_file_order(spark, folder):
    text = "id\n" + "\n".join(str(i) for i in range(500)) + "\n"
    df = L.scan_delimited(spark, write(folder / "f.csv", text, "utf-8"), with_ordinal=True)
    assert [r.id for r in df.orderBy(L.ORDINAL).collect()] == [str(i) for i in range(500)]


def test_missing_files_and_columns(spark, folder):
    with pytest.raises(FileNotFoundError):
        L.scan_delimited(spark, str(folder / "none.csv"))
    with pytest.raises(L.MissingColumns):
        L.check_columns(CUSTOMER, ["accountname"])
    write(folder / "Customer.csv", " accountid ;accountname\n1;Ann\n", "utf-8")
    assert L.stage(spark, str(folder), "Customer").columns == ["accountid", "accountname", L.ORDINAL]


def test_written_files_read_back(spark, folder):
    df = spark.createDataFrame([("1", "  é€ ", None), ("2", "x;y", "z")], "a string, b string, c string")
    for encoding in ("utf-8", "cp1252"):
        path = str(folder / encoding)
        L.write_delimited(df, path, encoding)
        back = L.scan_delimited(spark, path, ["utf-8", "cp1252"])
        assert sorted(tuple(r) for r in back.collect()) == [("1", "  é€ ", None), ("2", "x;y", "z")]
        assert L.count_lines(spark, path).first().lines == 2


def test_amounts_are_written_with_the_decimals_they_have(spark, folder):
    df = spark.createDataFrame([("5",), ("12.345",), ("7.1",), ("0.000001",)], "v string").selectExpr("cast(v as decimal(20,6)) as v")
    L.write_delimited(df, str(folder / "amounts"))
    assert sorted(r.v or "" for r in L.scan_delimited(spark, str(folder / "amounts")).collect()) == ["0.000001", "12.345", "5.00", "7.10"]


def test_readers_see_the_last_whole_version(spark, folder):
    store = TableStore(spark, str(folder / "store"))
    with pytest.raises(FileNotFoundError):
        store.read("t")
    store.write("t", spark.range(3))
    store.write("t", spark.range(5))
    assert store.read("t").count() == 5
    (folder / "store" / "t" / "v000002" / "_SUCCESS").unlink()
    assert store.read("t").count() == 3
    assert store.write("t", spark.range(7)).count() == 7
    assert store.versions("t") == ["v000001", "v000003"]


def test_finished_stages_are_not_run_again(spark, folder):
    store = TableStore(spark, str(folder / "stages"))
    runs = []

    def build():
        runs.append(1)
        return spark.range(4)

    for _ in range(2):
        assert store.read_or_build("t", build).count() == 4
    assert len(runs) == 1


# ---- records over splits ----------------------------------------------------------------------


def state_machine(text):
    """Records of a text, sign by sign: a quote counts at the beginning of a field, doubled ones inside."""
    records, now, state = [], "", "start"
    for i, c in enumerate(text):
        if state == "quoted":
            state = "closing" if c == '"' else "quoted"
        elif state == "closing" and c == '"':
            state = "quoted"
        elif state == "start" and c == '"':
            state = "quoted"
        elif c == "\n":
            records.append(now)
            now, state = "", "start"
            continue
        else:
            state = "start" if c == ";" else "field"
        now += c
    return records + ([now] if now else [])


def many_records(n, seed):
    pick = random.Random(seed)
    fields = ["a", "", '"b"', '"c\nd"', '"e ""f"" ;\n\n;g"', 'h"i', '"j"k', '""', '"\n"', "été", '"""\n"""', "l" * 40]
    rows = [";".join(pick.choice(fields) for _ in range(3)) for _ in range(n)]
    return "x;y;z\n" + "\n".join(rows) + "\n"


@pytest.mark.parametrize("size", [61, 300, 1 << 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_records_do_not_depend_on_splits(spark, folder, size, seed):
    text = many_records(60, seed)
    path = write(folder / f"s{seed}.csv", text, "utf-8")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        stored = R.store_records(spark, path)
        splits = stored.filter(F.col("kind") == R.SPLIT).count()
        found = [r.raw.decode() for r in R.records(stored).orderBy("block", "place").collect()]
        fields = [tuple(r) for r in L.scan_delimited(spark, path).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert found == state_machine(text)
    assert splits > len(text) / size / 30 or size > 1000
    expected = csv.reader(io.StringIO(text.split("\n", 1)[1], newline=""), delimiter=";")
    # What follows a closing quote: the parser keeps the quotes then, the csv module does not.
    same = {"": "-", None: "-", "jk": '"j"k'}
    shown = lambda row: tuple(same.get(f, f) for f in row)
    assert sorted(map(shown, fields)) == sorted(shown(r) for r in expected)


@settings(max_examples=300, deadline=None)
@given(st.text('ab;"\n', max_size=60), st.integers(1, 9))
def test_states_of_splits_compose(text, size):
    """Lines dealt to splits of any size: states composed from the splits give the records of the whole text."""
    lines = [x.encode() for x in text.split("\n")]
    splits = [lines[i : i + size] for i in range(0, len(lines), size)]
    inside, pieces = False, []
    for k, part in enumerate(splits):
        cutter = R.SplitCutter("f", k)
        rows = [r for b in (*cutter.add(pa.array(part, pa.binary())), *cutter.end()) for r in b.to_pylist()]
        said = rows.pop()
        if inside:
            early = [x for r in sorted((r for r in rows if r["early"]), key=lambda r: r["place"]) for x in r["raw"].split(b"\n")]
            again = R.SplitCutter("f", k, inside=True)
            rows = [r for r in rows if not r["early"]]
            rows += [r for b in (*again.add(pa.array(early, pa.binary())), *again.end(say=False)) for r in b.to_pylist()]
        for r in sorted(rows, key=lambda r: r["place"]):
            if r["kind"] == R.HEAD:
                pieces[-1] += b"\n" + r["raw"]
            else:
                pieces.append(r["raw"])
        inside = said["from_inside"] if inside else said["from_outside"]
    whole = state_machine(text)
    if text.endswith("\n") or not text:
        whole.append("") if len(pieces) > len(whole) else None
    assert [p.decode() for p in pieces] == whole


def test_folders_of_several_encodings(spark, folder):
    many = folder / "many"
    many.mkdir()
    for i in range(4):
        write(many / f"u{i}.csv", f"id;name\nu{i};Café € {i}\n", "utf-8")
        write(many / f"c{i}.csv", f"id;name\nc{i};Café € {i}\n", "cp1252")
    found = L.encodings_at(spark, str(many), ["utf-8", "cp1252"]).collect()
    assert {(r.file.rsplit("/", 1)[1][0], r.encoding) for r in found} == {("u", "utf-8"), ("c", "cp1252")}
    df = L.scan_delimited(spark, str(many))
    assert {(r.id, r["name"]) for r in df.collect()} == {(f"{c}{i}", f"Café € {i}") for c in "uc" for i in range(4)}
    with pytest.raises(ValueError, match="several encodings"):
        L.detect_encoding(spark, str(many), ["utf-8", "cp1252"])
    (many / "z.csv").write_bytes(b"id;name\n1;\x81\n")
    with pytest.raises(ValueError, match="none of"):
        L.scan_delimited(spark, str(many))


def test_the_bytes_of_a_file_are_read_once(spark, folder):
    path = write(folder / "once.csv", "id;v\n1;a\n2;b\n", "utf-8")
    df = L.scan_delimited(spark, path)
    (folder / "once.csv").unlink()
    assert df.count() == 2
    assert "once.csv" not in df._jdf.queryExecution().executedPlan().toString()


def test_headers_of_a_folder_agree(spark, folder):
    many = folder / "heads"
    many.mkdir()
    write(many / "a.csv", "id;v\n1;a\n", "utf-8")
    write(many / "b.csv", "v;id\na;1\n", "utf-8")
    with pytest.raises(ValueError, match="different columns"):
        L.scan_delimited(spark, str(many))


def test_line_breaks_in_quotes_through_a_stage(spark, folder):
    text = 'accountid;accountname;regionid\n1;"Ann\nand ""Bob""";7\n2;"a;\r\nb";\n3;Carl;8\n'
    write(folder / "Customer.csv", text, "utf-8")
    found = L.stage(spark, str(folder), "Customer").orderBy(L.ORDINAL).drop(L.ORDINAL).collect()
    assert [tuple(r) for r in found] == [("1", 'Ann\nand "Bob"', "7"), ("2", "a;\nb", None), ("3", "Carl", "8")]


# ---- publishing and batches -------------------------------------------------------------------


def test_readers_see_all_tables_of_one_publish(spark, folder):
    store = TableStore(spark, str(folder / "star"))
    assert store.snapshot().tables == {}
    store.write("Dim", spark.range(3))
    store.write("Fact", spark.range(30))
    store.publish(["Dim", "Fact"])
    reader = store.snapshot()
    store.write("Dim", spark.range(4))
    assert store.snapshot().read("Dim").count() == 3  # a reload is under way
    store.write("Fact", spark.range(40))
    store.publish(["Dim", "Fact"])
    assert (reader.read("Dim").count(), reader.read("Fact").count()) == (3, 30)
    assert [store.snapshot().read(t).count() for t in ("Dim", "Fact")] == [4, 40]
    assert store.publish(["Dim", "Fact"]).number == 2  # nothing new
    store.write("Fact", spark.range(50))
    store.publish(["Fact"])
    assert store.retain(1) == ["Dim/v000001", "Fact/v000001", "Fact/v000002"]
    assert store.snapshot().read("Fact").count() == 50 and store.snapshot().number == 3


def test_one_of_two_writers_publishes(spark, folder):
    store = TableStore(spark, str(folder / "race"))
    store.write("t", spark.range(1))
    base = store.publish(["t"])
    store.write("t", spark.range(2))
    store.publish(["t"], base=base)
    store.write("t", spark.range(3))
    with pytest.raises(StalePublish):
        store.publish(["t"], base=base)
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: create_once(spark, str(folder / "x" / "one"), str(i)), range(8)))
    assert sum(won) == 1 and read_text(spark, str(folder / "x" / "one")) == str(won.index(True))
    with ThreadPoolExecutor(6) as pool:
        sizes = [r.count() for r in pool.map(lambda i: store.write("many", spark.range(i + 1)), range(6))]
    assert sorted(sizes) == [1, 2, 3, 4, 5, 6] and len(store.versions("many")) == 6


def test_batches_are_added_once_and_touch_no_other_files(spark, folder):
    store = TableStore(spark, str(folder / "batches"))
    rows = spark.range(12).select("id", (F.col("id") % 3 + 202401).cast("int").alias("m"))
    store.write("t", rows.filter("id < 6"), ["m"])
    base = store.publish(["t"])
    files = lambda: {p: p.stat().st_mtime_ns for p in (folder / "batches" / "t").rglob("*.parquet")}
    before = files()
    added = store.append("t", rows.filter("id >= 6 and m = 202402"), "two", base, ["m"])
    store.append("t", rows.filter("id >= 6 and m = 202402"), "two", base, ["m"])  # a first attempt that was lost
    assert store.read("t").count() == 6
    store.publish([], {"t": added}, "two", base)
    assert sorted(r.id for r in store.read("t").collect()) == [0, 1, 2, 3, 4, 5, 7, 10]
    assert store.snapshot().batches == ("two",)
    assert before.items() <= files().items()
    third = store.append("t", rows.filter("id = 6"), "three", store.snapshot(), ["m"])
    store.publish([], {"t": third}, "three")
    assert store.read("t").count() == 9 and store.read("t").columns == ["id", "m"]
    assert store.append("t", rows.filter("id < 0"), "none", store.snapshot(), ["m"]) is None
    plan = store.read("t").filter("m = 202403")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(m") == 2
    store.write("t", store.read("t"), ["m"])
    assert store.read("t").count() == 9  # a new version holds what its batches held
    assert store.publish(["t"]).tables["t"] == ("v000002", ())
