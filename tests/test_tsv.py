"""COPY text dialect: exact round trip and failure on malformed rows."""

import os

import pytest
from pyspark.sql import types as T

from reelmart.sources.catalog import raw_schema
from reelmart.sources.ingest import load_audit, load_raw, raw_key_violations, read_raw
from reelmart.sources.tsv import read_copy_text, write_copy_text

TRICKY = [
    ("tt1", None, "", '"quoted', 'in "side" quotes', "back\\slash", "tab\there", "new\nline", " lead"),
    ("tt2", "movie", "\\N", "cr\rx", "\\\\", "a,b", "''", "x", None),
]


def _basics(spark, rows):
    return spark.createDataFrame(rows, raw_schema("title_basics"))


def test_round_trip_is_exact(spark, tmp_dir):
    df = _basics(spark, TRICKY)
    write_copy_text(df, f"{tmp_dir}/tb", "title_basics")
    back = read_copy_text(spark, f"{tmp_dir}/tb", "title_basics")
    assert sorted(back.collect()) == sorted(df.collect())


def test_reader_parses_hand_written_file(spark, tmp_dir):
    path = f"{tmp_dir}/title.ratings.tsv"
    with open(path, "w") as fh:
        fh.write("tconst\taverageRating\tnumVotes\n")
        fh.write("tt1\t7.5\t\\N\n")
        fh.write("tt2\t\t12\n")
        fh.write("tt3\ta\\tb\\\\N\t3\n")
    rows = {r.tconst: r for r in read_copy_text(spark, path, "title_ratings").collect()}
    assert rows["tt1"].numvotes is None and rows["tt1"].averagerating == "7.5"
    assert rows["tt2"].averagerating == ""  # empty field stays the empty string
    assert rows["tt3"].averagerating == "a\tb\\N"  # escaped backslash before N is data, not NULL


def test_short_row_fails(spark, tmp_dir):
    path = f"{tmp_dir}/bad.tsv"
    with open(path, "w") as fh:
        fh.write("tconst\taverageRating\tnumVotes\n")
        fh.write("tt1\t7.5\n")
    with pytest.raises(Exception, match="expected 3 fields"):
        read_copy_text(spark, path, "title_ratings").collect()


def test_load_raw_reports_missing_files_and_audits(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/title.ratings.tsv", "w") as fh:
        fh.write("tconst\taverageRating\tnumVotes\n")
        fh.write("tt1\t7.5\t10\ntt2\t6.0\t20\n")
    results = load_raw(spark, landing, f"{tmp_dir}/raw")
    status = {r.table: r.loaded for r in results}
    assert status == {"title_basics": False, "title_ratings": True, "title_akas": False,
                      "title_principals": False, "name_basics": False}
    audit = {r.table_name: (r.row_count, r.has_data) for r in load_audit(read_raw(spark, f"{tmp_dir}/raw")).collect()}
    assert audit == {"title_ratings": (2, True)}


def test_duplicate_key_blocks_publish(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/title.ratings.tsv", "w") as fh:
        fh.write("tconst\taverageRating\tnumVotes\n")
        fh.write("tt1\t7.5\t10\ntt1\t6.0\t20\n")
    results = {r.table: r for r in load_raw(spark, landing, f"{tmp_dir}/raw")}
    assert not results["title_ratings"].loaded
    assert "KeyViolationError" in results["title_ratings"].message


def test_raw_key_violations_finds_null_and_duplicates(spark):
    schema = T.StructType([T.StructField("tconst", T.StringType()), T.StructField("averagerating", T.StringType()),
                           T.StructField("numvotes", T.StringType())])
    df = spark.createDataFrame([("a", "1", "1"), ("a", "2", "2"), (None, "3", "3"), ("b", "4", "4")], schema)
    got = {(r.key_value, r.n_records, r.problem) for r in raw_key_violations({"title_ratings": df}).collect()}
    assert got == {("a", 2, "duplicate key"), (None, 1, "null key")}


def test_append_rejects_key_already_published(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/title.ratings.tsv", "w") as fh:
        fh.write("tconst\taverageRating\tnumVotes\n")
        fh.write("tt1\t7.5\t10\n")
    first = {r.table: r for r in load_raw(spark, landing, f"{tmp_dir}/raw", mode="append")}
    assert first["title_ratings"].loaded
    second = {r.table: r for r in load_raw(spark, landing, f"{tmp_dir}/raw", mode="append")}
    assert not second["title_ratings"].loaded and "KeyViolationError" in second["title_ratings"].message
    assert read_raw(spark, f"{tmp_dir}/raw")["title_ratings"].count() == 1


def test_round_trip_property(spark, tmp_dir):
    """Random text with tabs, newlines, CR, backslashes, literal \\N and NULLs survives write + read."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(["a", "Z", " ", "\t", "\n", "\r", "\\", "N", '"', ",", "é", "≤"])
    field = st.one_of(st.none(), st.text(alphabet, max_size=12))
    row = st.tuples(*[field] * 3)
    counter = iter(range(10_000))

    @settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=1, max_size=20))
    def check(rows):
        df = spark.createDataFrame(rows, raw_schema("title_ratings"))
        path = f"{tmp_dir}/prop-{next(counter)}"
        write_copy_text(df, path, "title_ratings")
        back = read_copy_text(spark, path, "title_ratings")
        assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)

    check()


def test_load_append_requires_all_files_and_counts_rows(spark, tmp_dir):
    from reelmart.constants import SOURCE_FILES, RAW_COLUMNS
    from reelmart.sources.ingest import LoadFailedError, load_append

    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    for i, (file_name, table) in enumerate(SOURCE_FILES.items()):
        if i == 4:
            break
        with open(f"{landing}/{file_name}", "w") as fh:
            fh.write("\t".join(RAW_COLUMNS[table]) + "\n")
            fh.write("\t".join([f"k{i}"] + ["x"] * (len(RAW_COLUMNS[table]) - 1)) + "\n")
    with pytest.raises(LoadFailedError, match="Missing landing files"):
        load_append(spark, landing, f"{tmp_dir}/raw")
    file_name, table = list(SOURCE_FILES.items())[4]
    with open(f"{landing}/{file_name}", "w") as fh:
        fh.write("\t".join(RAW_COLUMNS[table]) + "\n")
        fh.write("\t".join(["nm1"] + ["x"] * (len(RAW_COLUMNS[table]) - 1)) + "\n")
        fh.write("short\trow\n")  # this file fails: counts 0 rows
    assert load_append(spark, landing, f"{tmp_dir}/raw") == 4


def test_reset_raw_then_load_if_empty_reloads(spark, tmp_dir):
    from reelmart.constants import RAW_COLUMNS, SOURCE_FILES
    from reelmart.sources.ingest import load_if_empty, reset_raw

    landing = f"{tmp_dir}/landing"
    os.makedirs(landing)
    with open(f"{landing}/title.basics.tsv", "w") as fh:
        fh.write("tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n")
        fh.write("tt1\tmovie\tA\tA\t0\t2000\t\\N\t90\tDrama\n")
    raw = f"{tmp_dir}/raw"
    assert load_if_empty(spark, landing, raw) is not None      # absent: loads
    assert load_if_empty(spark, landing, raw) is not None      # four tables are still missing
    for file_name, table in SOURCE_FILES.items():
        if table != "title_basics":
            with open(f"{landing}/{file_name}", "w") as fh:
                fh.write("header\n" + "\t".join(["k"] + ["x"] * (len(RAW_COLUMNS[table]) - 1)) + "\n")
    assert load_if_empty(spark, landing, raw) is not None
    assert load_if_empty(spark, landing, raw) is None          # all present: skipped
    reset_raw(spark, raw)
    assert read_raw(spark, raw)["title_basics"].count() == 0
    assert read_raw(spark, raw)["name_basics"].columns == ["nconst", "primaryname", "birthyear", "deathyear",
                                                                  "primaryprofession", "knownfortitles"]
    assert load_if_empty(spark, landing, raw) is not None      # empty again: reloads
    assert read_raw(spark, raw)["title_basics"].count() == 1


def test_header_with_byte_order_mark_and_crlf(spark, tmp_dir):
    path = f"{tmp_dir}/title.ratings.tsv"
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write("\ufefftconst\taverageRating\tnumVotes\r\n")
        fh.write("tt1\t7.5\t10\r\n")
    rows = read_copy_text(spark, path, "title_ratings").collect()
    assert [(r.tconst, r.averagerating, r.numvotes) for r in rows] == [("tt1", "7.5", "10")]


def test_line_one_is_the_header_whatever_it_says(spark, tmp_dir):
    for name, first in (("a.tsv", "anything at all"), ("b.tsv", "tconst\taverageRating\tnumVotes")):
        with open(f"{tmp_dir}/{name}", "w") as fh:
            fh.write(f"{first}\ntt{name}\t1\t2\ntconst\taveragerating\tnumvotes\n")
    got = sorted(r.tconst for r in read_copy_text(spark, [f"{tmp_dir}/a.tsv", f"{tmp_dir}/b.tsv"], "title_ratings").collect())
    assert got == ["tconst", "tconst", "tta.tsv", "ttb.tsv"]


def test_octal_and_hex_escapes_and_end_marker(spark, tmp_dir):
    path = f"{tmp_dir}/title.ratings.tsv"
    with open(path, "w") as fh:
        fh.write("h\n" + "\\101\\x42\\103x\t\\xC3\\xA9\\q\\\\n\ta\\tb\\N\n" + '"q\t\\7\t \n' + "\\.\n")
    rows = read_copy_text(spark, path, "title_ratings").collect()
    assert [tuple(r) for r in rows] == [("ABCx", "éq\\n", "a\tbN"), ('"q', "\x07", " ")]


def test_a_lone_carriage_return_is_data(spark, tmp_dir):
    path = f"{tmp_dir}/title.ratings.tsv"
    with open(path, "w", newline="") as fh:
        fh.write("h\r\na\rb\t1\t2\r\n")
    assert [tuple(r) for r in read_copy_text(spark, path, "title_ratings").collect()] == [("a\rb", "1", "2")]


def test_blank_lines_are_refused(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/landing")
    with open(f"{tmp_dir}/landing/title.ratings.tsv", "w") as fh:
        fh.write("h\ntt1\t1\t2\n\t\t\n")
    result = {r.table: r for r in load_raw(spark, f"{tmp_dir}/landing", f"{tmp_dir}/raw")}["title_ratings"]
    assert not result.loaded and "BlankLineError" in result.message


def test_failed_refresh_keeps_the_old_table_and_two_roots_stay_apart(spark, tmp_dir):
    def land(name, rows):
        os.makedirs(f"{tmp_dir}/{name}")
        with open(f"{tmp_dir}/{name}/title.ratings.tsv", "w") as fh:
            fh.write("h\n" + "".join(rows))

    land("a", [f"tt{i}\t1\t2\n" for i in range(5)])
    land("b", [f"tt{i}\t1\t2\n" for i in range(9)])
    land("bad", ["tt1\t1\t2\n", "short\n"])
    load_raw(spark, f"{tmp_dir}/a", f"{tmp_dir}/ra", buckets=2)
    load_raw(spark, f"{tmp_dir}/b", f"{tmp_dir}/rb", buckets=2)
    load_raw(spark, f"{tmp_dir}/bad", f"{tmp_dir}/ra", buckets=2)
    assert read_raw(spark, f"{tmp_dir}/ra")["title_ratings"].count() == 5
    assert read_raw(spark, f"{tmp_dir}/rb")["title_ratings"].count() == 9


def test_audit_counts_missing_and_unreadable_tables_as_empty(spark, tmp_dir):
    import shutil

    from reelmart.sources.ingest import audit_raw
    from reelmart.sources.store import published

    os.makedirs(f"{tmp_dir}/landing")
    with open(f"{tmp_dir}/landing/title.ratings.tsv", "w") as fh:
        fh.write("h\ntt1\t1\t2\n")
    load_raw(spark, f"{tmp_dir}/landing", f"{tmp_dir}/raw")
    got = {r.table_name: (r.row_count, r.has_data) for r in audit_raw(spark, f"{tmp_dir}/raw").collect()}
    assert got["title_ratings"] == (1, True) and got["title_basics"] == (0, False) and len(got) == 5
    shutil.move(published(spark, f"{tmp_dir}/raw")["title_ratings"].parts[0], f"{tmp_dir}/elsewhere")
    assert {r.has_data for r in audit_raw(spark, f"{tmp_dir}/raw").collect()} == {False}


def test_empty_folder_is_no_landing_file(spark, tmp_dir):
    from reelmart.sources.tsv import path_exists

    os.makedirs(f"{tmp_dir}/empty")
    assert not path_exists(spark, f"{tmp_dir}/empty") and not path_exists(spark, f"{tmp_dir}/none")


def _landing_file(folder, lines, name="title.ratings.tsv"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as fh:
        fh.write("".join(lines))


def _ratings(spark, root):
    from reelmart.sources.ingest import read_raw

    return sorted(tuple(r) for r in read_raw(spark, root)["title_ratings"].collect())


def test_data_lines_that_equal_the_header_are_kept(spark, tmp_dir):
    _landing_file(f"{tmp_dir}/landing", ["tt5\t5\t5\n", "tt1\t1\t1\n", "tt5\t5\t5\n", "tt2\t2\t2"])
    for buckets in (None, 2):
        result = {r.table: r for r in load_raw(spark, f"{tmp_dir}/landing", f"{tmp_dir}/raw{buckets}", buckets=buckets)}["title_ratings"]
        assert result.rows == 3 and _ratings(spark, f"{tmp_dir}/raw{buckets}") == [("tt1", "1", "1"), ("tt2", "2", "2"), ("tt5", "5", "5")]


def test_folder_of_files_with_different_headers(spark, tmp_dir):
    folder = f"{tmp_dir}/landing/title.ratings.tsv"
    _landing_file(folder, ["a\tb\tc\n", "tt1\t1\t1\n", "x\ty\tz\n"], "one")  # holds the other file's header as a row
    _landing_file(folder, ["x\ty\tz\n", "tt2\t2\t2\n"], "two")
    _landing_file(folder, [], "three")
    result = {r.table: r for r in load_raw(spark, f"{tmp_dir}/landing", f"{tmp_dir}/raw")}["title_ratings"]
    assert result.loaded and _ratings(spark, f"{tmp_dir}/raw") == [("tt1", "1", "1"), ("tt2", "2", "2"), ("x", "y", "z")]


def test_a_load_reads_the_text_once(spark, tmp_dir):
    from reelmart.sources.ingest import load_files
    from reelmart.sources.tsv import scan_landing

    _landing_file(f"{tmp_dir}/landing", ["h\n"] + [f"tt{i}\t{i}\t{i}\n" for i in range(50)])
    rows, headers = scan_landing(spark, f"{tmp_dir}/landing/title.ratings.tsv", "title_ratings")
    assert headers == {"h": 1}
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    reads = []
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = spark._jsparkSession.sharedState().statusStore().executionsCount()
    load_files(spark, f"{tmp_dir}/landing/title.ratings.tsv", f"{tmp_dir}/raw", "title_ratings")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    status = spark._jsparkSession.sharedState().statusStore()
    runs = status.executionsList(int(before), 1000)
    for i in range(runs.size()):
        reads.append(runs.apply(i).physicalPlanDescription().count("Scan text"))
    # the head of the file (a limit), and the load itself; a plan description names a scan twice
    assert sum(1 for n in reads if n) == 2


def test_append_reads_the_key_index_of_the_buckets_it_needs(spark, tmp_dir):
    from reelmart.sources import ingest as I
    from reelmart.sources.store import published

    _landing_file(f"{tmp_dir}/l0", ["h\n"] + [f"tt{i}\t{i}\t{i}\n" for i in range(400)])
    I.load_raw(spark, f"{tmp_dir}/l0", f"{tmp_dir}/raw")
    _landing_file(f"{tmp_dir}/l1", ["h\n", "tt900\t1\t1\n", "tt901\t1\t1\n"])
    I.load_raw(spark, f"{tmp_dir}/l1", f"{tmp_dir}/raw", mode="append")
    entry = published(spark, f"{tmp_dir}/raw")["title_ratings"]
    first, second = entry.measured[I.KEY_INDEX]
    look = I.colliding_keys(spark, [first], second)
    read = [f for f in look.inputFiles() if f"{first}/" in f]
    plan = look._jdf.queryExecution().executedPlan().toString()
    assert read and not any(f.startswith(tuple(entry.parts)) for f in look.inputFiles()) and "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "[bucket")
    assert look.isEmpty() and entry.rows == 402
    for i, bad in enumerate((["tt7\t1\t1\n"], ["tt901\t1\t1\n"], ["tt950\t1\t1\n", "tt950\t2\t2\n"], ["\\N\t1\t1\n"])):
        _landing_file(f"{tmp_dir}/bad {i}", ["h\n", "tt990\t1\t1\n", *bad])
        result = {r.table: r for r in I.load_raw(spark, f"{tmp_dir}/bad {i}", f"{tmp_dir}/raw", mode="append")}["title_ratings"]
        assert not result.loaded and "KeyViolationError" in result.message
    assert len(_ratings(spark, f"{tmp_dir}/raw")) == 402


def test_append_to_a_table_published_without_an_index(spark, tmp_dir):
    from reelmart.sources import ingest as I
    from reelmart.sources.store import publish

    spark.createDataFrame([("tt1", "1", "1")], "tconst string, averagerating string, numvotes string").write.parquet(f"{tmp_dir}/raw/title_ratings/old")
    publish(spark, f"{tmp_dir}/raw", "title_ratings", [f"{tmp_dir}/raw/title_ratings/old"], 1)
    _landing_file(f"{tmp_dir}/same", ["h\n", "tt1\t1\t1\n"])
    _landing_file(f"{tmp_dir}/new", ["h\n", "tt2\t1\t1\n"])
    ok = {n: {r.table: r for r in I.load_raw(spark, f"{tmp_dir}/{n}", f"{tmp_dir}/raw", mode="append")}["title_ratings"].loaded for n in ("same", "new")}
    assert ok == {"same": False, "new": True} and len(_ratings(spark, f"{tmp_dir}/raw")) == 2
