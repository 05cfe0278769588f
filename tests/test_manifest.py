"""Locations, artefact fan-out, de-duplication, reconciliation and the
failure summary."""

import pytest
from pyspark.sql import functions as F

from gleaner.functions import scalar as X
from gleaner.operators import manifest as M


def test_location_bucket_wins(spark):
    df = spark.createDataFrame([("transformed/d/r.parquet",)], "p string")
    got = df.select(X.resource_location("p", "brownfield-land", bucket="bkt",
                                        base_url="https://x/")).first()[0]
    assert got == "s3://bkt/brownfield-land-collection/transformed/d/r.parquet"


def test_location_base_url_trailing_slashes(spark):
    df = spark.createDataFrame([("collection/resource/abc",)], "p string")
    got = df.select(X.resource_location("p", "c", base_url="https://files.example.org///")).first()[0]
    assert got == "https://files.example.org/c-collection/collection/resource/abc"


def test_location_needs_bucket_or_base(spark):
    with pytest.raises(ValueError, match="Either bucket or base_url"):
        X.resource_location("p", "c")


def test_split_s3_url(spark):
    df = spark.createDataFrame([("s3://bucket/path/to/key.csv",)], "u string")
    r = df.select(X.split_s3_url("u").alias("s")).select("s.*").first()
    assert (r["bucket"], r["key"]) == ("bucket", "path/to/key.csv")


def test_fan_out_five_artefacts(spark):
    pairs = spark.createDataFrame([("ds", "res")], "dataset string, resource string")
    got = [r["remote_path"] for r in M.artefact_paths(pairs).orderBy("ordinal").collect()]
    assert got == ["transformed/ds/res.parquet", "issue/ds/res.csv", "var/column-field/ds/res.csv",
                   "var/dataset-resource/ds/res.csv", "var/converted-resource/ds/res.csv"]


def test_dedup_last_path_wins(spark):
    m = spark.createDataFrame([("u", "p1", 1), ("u", "p2", 2), ("v", "p3", 1)],
                              "url string, path string, seq int")
    got = {r["url"]: r["path"] for r in M.dedup_manifest(m, "seq").collect()}
    assert got == {"u": "p2", "v": "p3"}


def test_reconcile_and_summary(spark):
    exp = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    present = spark.createDataFrame([("a",), ("c",), ("zzz",)], "url string")
    rec = M.reconcile_manifest(exp, present)
    s = M.summarise_manifest(rec).first()
    assert (s["downloaded"], s["not_found"]) == (2, 1)


def test_files_per_task_zero_tasks(spark):
    empty = spark.createDataFrame([], "dataset string, resource string")
    man = spark.createDataFrame([], "url string, path string")
    assert M.files_per_task(man, empty).first()["files_per_task"] == 0


def test_failed_urls_are_all_listed_in_a_file(spark, tmp_path):
    rec = spark.createDataFrame([("https://x/a", False), ("https://x/b", True), ("https://x/c", False)],
                                "url string, present boolean")
    with pytest.raises(RuntimeError) as err:
        M.raise_on_failed(rec, str(tmp_path / "failed"))
    assert str(err.value) == f"Failed to download 2 file(s), listed in {tmp_path / 'failed'}"
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "failed")).collect()) == ["https://x/a", "https://x/c"]
    ok = rec.where("present")
    M.raise_on_failed(ok, str(tmp_path / "none"))


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("a/b/issue/ds1/abc.csv", "  x  y ", "brownfield-land-collection",
                                 "tmp/collection/resource/0af3c9")],
                               "p string, w string, c string, r string")
    r = df.select(X.base_name("p"), X.dataset_from_path("p"), F.size(X.split_words("w")),
                  X.strip_collection_suffix("c"), X.hash_from_path("r"),
                  F.size(X.split_words(F.lit(None).cast("string")))).first()
    assert tuple(r) == ("abc.csv", "ds1", 2, "brownfield-land", "0af3c9", 0)
