"""Documents read in byte ranges against the whole-file form."""

import json
import os
import random

import pytest

from aerolake.sources import ingest
from aerolake.sources.split_documents import read_documents_split
from tests.fixtures import F1_ROWS, write_document

rng = random.Random(12)
ODD = ["]", "[", "],[", 'a"]"b', "\\", '\\"]', "é]漢", "", None, "x, y", 0, -1.5, True, [1, [2, "]"]], []]


@pytest.fixture()
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _rows(df):
    return sorted(repr(r.row) for r in df.collect())


def test_equals_the_whole_file_form(spark, tmp_dir, small_ranges):
    for k, n in enumerate((0, 1, 200)):
        rows = [[rng.choice(ODD) for _ in range(rng.randrange(1, 6))] for _ in range(n)]
        write_document(os.path.join(tmp_dir, f"d{k}.json"), rows, pretty=k == 1)
    write_document(os.path.join(tmp_dir, "flights.json"), F1_ROWS, pretty=True)
    with open(os.path.join(tmp_dir, "newline.json"), "w") as fh:
        fh.write(" [ [1 ] ,\n[\"]\"]\n] \n")
    with open(os.path.join(tmp_dir, "blank.json"), "w") as fh:
        fh.write("  ")
    split = read_documents_split(spark, tmp_dir)
    assert spark.read.option("lineSep", "]").text(tmp_dir).rdd.getNumPartitions() > 10      # one file, many tasks
    assert _rows(split) == _rows(ingest.read_state_vectors(spark, tmp_dir))


@pytest.mark.parametrize("text", ["[[1],[2]", "[[1],[2", "[[1]][[2]]", "[[1],]", "[1,[2]]", "[[1] [2]]", "[[\"a]]", "{}", "[[1]]x", "]", "[[1]]]"])
def test_malformed_documents_abort(spark, tmp_dir, text):
    with open(os.path.join(tmp_dir, "bad.json"), "w") as fh:
        fh.write(text)
    write_document(os.path.join(tmp_dir, "good.json"), [[1]])
    with pytest.raises(Exception, match="MALFORMED"):
        read_documents_split(spark, tmp_dir).collect()


def test_a_file_without_rows(spark, tmp_dir):
    write_document(os.path.join(tmp_dir, "e.json"), [])
    assert read_documents_split(spark, tmp_dir).count() == 0
    assert json.loads("[]") == []
