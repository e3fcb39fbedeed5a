"""The streaming appender loads each landing file exactly once, over whatever was loaded before."""

import os

from reelmart.sources.ingest import load_raw, read_raw
from reelmart.streaming.landing import append_new_landing_files


def _write(path, rows):
    with open(path, "w") as fh:
        fh.write("tconst\taverageRating\tnumVotes\n")
        for r in rows:
            fh.write("\t".join(r) + "\n")


def test_each_file_appended_once(spark, tmp_dir):
    landing, raw, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/ckpt"

    def table():
        return read_raw(spark, raw)["title_ratings"]

    os.makedirs(landing)
    _write(f"{landing}/title.ratings.tsv", [("tt1", "7.5", "10"), ("tt2", "", "\\N")])
    _write(f"{landing}/title.basics.tsv", [("tt9", "x", "y")])  # other table: ignored by the glob
    append_new_landing_files(spark, landing, "title_ratings", raw, ckpt)
    assert table().count() == 2
    append_new_landing_files(spark, landing, "title_ratings", raw, ckpt)  # nothing new
    assert table().count() == 2
    _write(f"{landing}/title.ratings.2024-06.tsv", [("tt3", "6.1", "5")])
    append_new_landing_files(spark, landing, "title_ratings", raw, ckpt)
    rows = {r.tconst: r for r in table().collect()}
    assert set(rows) == {"tt1", "tt2", "tt3"}
    assert rows["tt2"].averagerating == "" and rows["tt2"].numvotes is None


def test_stream_and_batch_appends_add_up(spark, tmp_dir):
    landing, more, raw = f"{tmp_dir}/landing", f"{tmp_dir}/more", f"{tmp_dir}/raw"
    for d in (landing, more, f"{tmp_dir}/last"):
        os.makedirs(d)
    _write(f"{landing}/title.ratings.tsv", [(f"tt{i}", "7.5", "10") for i in range(100)])
    load_raw(spark, landing, raw)
    _write(f"{more}/title.ratings.1.tsv", [(f"tt{i}", "7.5", "10") for i in range(100, 107)])
    append_new_landing_files(spark, more, "title_ratings", raw, f"{tmp_dir}/ckpt")
    assert read_raw(spark, raw)["title_ratings"].count() == 107
    _write(f"{tmp_dir}/last/title.ratings.tsv", [(f"tt{i}", "7.5", "10") for i in range(200, 250)])
    load_raw(spark, f"{tmp_dir}/last", raw, mode="append")
    assert read_raw(spark, raw)["title_ratings"].count() == 157


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_dir):
    from reelmart.sources.ingest import load_table
    from reelmart.sources.tsv import read_copy_text

    _write(f"{tmp_dir}/r.tsv", [("tt1", "7.5", "10")])
    df = read_copy_text(spark, f"{tmp_dir}/r.tsv", "title_ratings")
    assert load_table(spark, df, f"{tmp_dir}/raw", "title_ratings", "append", part_name="stream-x-0") == 1
    assert load_table(spark, df, f"{tmp_dir}/raw", "title_ratings", "append", part_name="stream-x-0") == 0
    assert read_raw(spark, f"{tmp_dir}/raw")["title_ratings"].count() == 1
