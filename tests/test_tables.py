import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickloom.session import scratch_path
from tickloom.sources import buckets, landing, tables
from tickloom.operators import lookups, monitor
from tickloom.plans import batch, serving


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def read(spark, path, version=None):
    return sorted(r.n for r in tables.read_table(spark, path, version).rows.collect())


def test_versions_append_and_replace(spark):
    path = scratch_path(spark, "v")
    assert tables.append_version(numbers(spark, 1, 2), path) == 0
    assert tables.append_version(numbers(spark, 3), path) == 1
    assert read(spark, path) == [1, 2, 3]
    assert tables.overwrite_version(numbers(spark, 9), path) == 2
    assert tables.append_version(numbers(spark, 10), path) == 3
    assert read(spark, path) == [9, 10]
    assert read(spark, path, 1) == [1, 2, 3]
    assert read(spark, path, 2) == [9]


def test_a_write_that_died_before_its_commit_is_invisible(spark):
    path = scratch_path(spark, "died")
    tables.append_version(numbers(spark, 1), path)
    numbers(spark, 666).write.parquet(f"{path}/data/_version=1")
    assert read(spark, path) == [1]
    assert tables.append_version(numbers(spark, 2), path) == 1
    assert read(spark, path) == [1, 2]


def test_empty_append_makes_no_version(spark):
    path = scratch_path(spark, "empty")
    assert tables.append_version(numbers(spark).limit(0), path) is None
    with pytest.raises(tables.TableUnavailable):
        tables.read_table(spark, path)


def test_replayed_batch_adds_nothing_and_a_new_app_does(spark):
    path = scratch_path(spark, "replay")
    assert tables.append_version(numbers(spark, 1), path, "a", 0) == 0
    assert tables.append_version(numbers(spark, 1), path, "a", 0) is None
    assert tables.append_version(numbers(spark, 2), path, "a", 1) == 1
    assert tables.append_version(numbers(spark, 3), path, "b", 0) == 2
    assert read(spark, path) == [1, 2, 3]


def test_new_rows_needs_a_baseline(spark):
    path = scratch_path(spark, "fresh")
    baseline = tables.append_version(numbers(spark, 1), path)
    tables.append_version(numbers(spark, 2, 3), path)
    assert tables.new_rows(spark, path, baseline) == 2
    with pytest.raises(ValueError):
        tables.new_rows(spark, path, None)


def landed(spark, *bars):
    return spark.createDataFrame(
        [(d, t, 1.0, 2.0, 0.5, c, 10.0) for d, t, c in bars],
        "Date string, Ticker string, Open double, High double, Low double, Close double, Volume double",
    )


def test_daily_run(spark):
    root = scratch_path(spark, "daily")
    portfolio = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",)], "Ticker string")
    frames = [
        landing.tidy_bars(landed(spark, ("2026-01-01 00:00:00-05:00", "aaa", 1.0))),
        landing.tidy_bars(landed(spark, ("2026-01-01", "BBB", 2.0), ("2026-01-02", "BBB", 3.0))),
    ]
    first = batch.run_ingest(frames, portfolio, f"{root}/raw", metrics_path=f"{root}/metrics")
    assert (first["rows_ingested"], first["tickers_ok"], first["tickers_failed"]) == (3, 2, 1)
    done = batch.daily_run(frames, portfolio, f"{root}/raw", f"{root}/curated", f"{root}/metrics")
    assert done["rows_in"] == 6 and done["rows_out"] == 3 and done["upstream_rows_ingested"] == 3
    assert rows(lookups.failed_tickers(portfolio, frames[0].unionByName(frames[1]))) == [{"Ticker": "CCC"}]
    got, version = serving.table_prices(spark, f"{root}/curated", tickers="aaa")
    assert version == 0 and rows(got)[0]["Date"] == "2026-01-01"
    gauges = {(r["job"], r["name"]): r["value"] for r in monitor.run_gauges(
        monitor.read_metrics(spark, f"{root}/metrics")).collect()}
    assert gauges[("batch_ingest", "rows_ingested")] == 3.0
    assert ("batch_ingest", "table_path") not in gauges


def test_empty_inputs_are_errors(spark):
    root = scratch_path(spark, "nothing")
    portfolio = spark.createDataFrame([("AAA",)], "Ticker string")
    with pytest.raises(RuntimeError):
        nothing = landing.tidy_bars(landed(spark, ("2026-01-01", "A", 1.0))).limit(0)
        batch.run_ingest([nothing], portfolio, f"{root}/raw")
    with pytest.raises(tables.TableUnavailable):
        batch.run_transform(spark, f"{root}/raw", f"{root}/curated")


def test_not_a_number_volume_fails(spark):
    bad = spark.createDataFrame(
        [("2026-01-01", "A", 1.0, 1.0, 1.0, 1.0, float("nan"))],
        "Date string, Ticker string, Open double, High double, Low double, Close double, Volume double",
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST_OVERFLOW"):
        landing.ingest_batch([bad], "2026-01-01T00:00:00+00:00").collect()


def test_csv_round_trip(spark):
    path = scratch_path(spark, "csv")
    bars = landed(spark, ("2026-01-01", "NOW", 1.5), ("2026-01-02", "NOW", 2.5), ("2026-01-01", "GLE.PA", 3.5))
    landing.export_csv_by_ticker(bars, path)
    back = landing.read_landed_bars(spark, path)
    assert sorted((r.Ticker, r.Date, r.Close) for r in back.collect()) == [
        ("GLE.PA", "2026-01-01", 3.5), ("NOW", "2026-01-01", 1.5), ("NOW", "2026-01-02", 2.5)]


def test_a_ticker_is_one_file_as_spark_writes_it(spark):
    """Odd names, empty and null ones, quotes, nulls; the file lies alone in its folder, and an export replaces the last."""
    from pathlib import Path

    bars = spark.createDataFrame(
        [("2026-01-01", "a/b=c%", 1.5, 1), ("2026-01-02", "a/b=c%", None, 2), ("x,\"y", None, 2.5, 3), (None, "é 1", 1e-9, None),
         ("2026-01-02", "", 3.0, 4), ("", "Z", float("nan"), 5)],
        "Date string, Ticker string, Close double, Volume long",
    )
    own, plain = (Path(scratch_path(spark, n).removeprefix("file:")) for n in ("own", "plain"))
    landing.export_csv_by_ticker(bars.withColumn("Ticker", F.lit("gone")), str(own))
    landing.export_csv_by_ticker(bars, str(own))
    ordered = bars.select("Ticker", "Date", "Close", "Volume").coalesce(1).sortWithinPartitions("Ticker", "Date")
    ordered.write.partitionBy("Ticker").option("header", True).csv(str(plain))

    def lines(top):
        return {d.name: sorted(x for f in d.glob("*.csv") for x in set(f.read_text().splitlines())) for d in top.glob("Ticker=*")}

    assert {k: sorted(set(v)) for k, v in lines(own).items()} == {k: sorted(set(v)) for k, v in lines(plain).items()}
    names = [f.name for d in own.glob("Ticker=*") for f in d.iterdir()]
    assert names and all(n.endswith(".csv") and n.startswith("part-") for n in names)
    assert landing.read_landed_bars(spark, str(own)).count() == 6


def test_seed_prices(spark):
    portfolio = spark.createDataFrame([("AAA",), ("BBB",), ("CCC",)], "Ticker string")
    bars = spark.createDataFrame(
        [("AAA", "2026-01-01", 1.0), ("AAA", "2026-01-02", None), ("BBB", "2026-01-01", 5.0), ("ZZZ", "2026-01-01", 9.0)],
        "Ticker string, Date string, Close double",
    )
    got = {r.Ticker: r.seed_price for r in lookups.seed_prices(portfolio, bars).collect()}
    assert got == {"AAA": 1.0, "BBB": 5.0, "CCC": 100.0}


@pytest.mark.parametrize("left_over", ["commits/commit=1/_temporary", "commits/commit=1-dead/_temporary/0"])
def test_a_write_that_died_in_its_commit_does_not_stop_the_next(spark, left_over):
    from pathlib import Path

    path = scratch_path(spark, "v")
    assert tables.append_version(numbers(spark, 1), path) == 0
    Path(path.removeprefix("file:"), left_over).mkdir(parents=True)
    assert tables.append_version(numbers(spark, 2), path) == 1
    assert read(spark, path) == [1, 2]


def test_rows_of_another_type_are_refused(spark):
    path = scratch_path(spark, "v")
    tables.append_version(numbers(spark, 1), path)
    with pytest.raises(ValueError, match="differ from the table in n"):
        tables.append_version(spark.createDataFrame([("x",)], "n string"), path)
    assert read(spark, path) == [1]


def entries(spark, **labels):
    return spark.createDataFrame([(k, v, {"a": v}) for k, v in labels.items()], "id string, v string, m map<string,string>")


def stored(spark, path):
    return {r.id: r.v for r in buckets.read(spark, path).collect()}


def test_buckets_store_only_what_changes(spark):
    path = scratch_path(spark, "buckets")
    many = {f"k{i}": "old" for i in range(40)}
    first = buckets.publish(entries(spark, **many), path, "id", count=8)
    assert (first.version, first.stored, first.kept) == (0, 8, 0)
    before = buckets.read_state(spark, path)
    one = buckets.upsert(entries(spark, k3="new"), path, "id")
    after = buckets.read_state(spark, path)
    assert (one.version, one.stored, one.kept) == (1, 1, 7)
    assert stored(spark, path) == many | {"k3": "new"} and after.rows == 40
    assert [b for b in before.live if before.live[b] != after.live[b]] == buckets.touched(entries(spark, k3="x"), before)
    assert buckets.upsert(entries(spark, k3="new"), path, "id").stored == 0
    files = buckets.read(spark, path).inputFiles()
    assert len({f.split("_bucket=")[1].split("/")[0] for f in files}) == 8
    # Publishing drops what is not there, and a bucket without rows.
    few = buckets.publish(entries(spark, k3="new", new="x"), path, "id")
    assert stored(spark, path) == {"k3": "new", "new": "x"} and few.stored + few.kept <= 2
    buckets.publish(entries(spark).limit(0), path, "id")
    assert stored(spark, path) == {} and buckets.read_state(spark, path).rows == 0


def test_bucket_rows_are_written_once(spark):
    """Straight to their place, without a scratch copy; buckets that turn out the same leave no files behind."""
    from pathlib import Path

    path = scratch_path(spark, "once")
    scratch = Path(path.removeprefix("file:")).parent
    before = set(scratch.glob("buckets-*"))
    many = {f"k{i}": "old" for i in range(40)}
    buckets.publish(entries(spark, **many), path, "id", count=8)
    one = buckets.publish(entries(spark, **many | {"k3": "new"}), path, "id")
    assert set(scratch.glob("buckets-*")) == before
    assert (one.stored, one.kept) == (1, 7)
    assert len(list(Path(path.removeprefix("file:"), "data", "_version=1").glob("_bucket=*"))) == 1
    assert stored(spark, path) == many | {"k3": "new"}


def test_a_bucket_write_that_died_is_invisible(spark):
    path = scratch_path(spark, "half")
    buckets.publish(entries(spark, a="1", b="2"), path, "id", count=4, notes={"model": "m1"})
    entries(spark, z="9").withColumn("_bucket", F.lit(2)).write.partitionBy("_bucket").parquet(f"{path}/data/_version=1")
    assert stored(spark, path) == {"a": "1", "b": "2"}
    assert buckets.upsert(entries(spark, b="3"), path, "id").version == 1
    assert stored(spark, path) == {"a": "1", "b": "3"} and buckets.read_state(spark, path).notes == {"model": "m1"}
    with pytest.raises(ValueError, match="columns"):
        buckets.replace(entries(spark, b="4").drop("m"), path, [0])
    with pytest.raises(tables.TableUnavailable):
        buckets.read(spark, scratch_path(spark, "never"))


def test_increments_equal_a_rebuild(spark):
    """New days, a late bar, a corrected bar, a new ticker and one without bars of late."""
    root = scratch_path(spark, "steps")

    def bar(ticker, day, close, stamp):
        date = f"2026-{1 + day // 28:02d}-{1 + day % 28:02d}"
        return (date, ticker, 1.0, 1.0, 1.0, float(close), 1, f"run-{stamp}")

    steps = [
        [bar(t, d, (d * 37) % 101 + 1, 0) for t in ("A", "B", "C") for d in range(120) if d % 7],
        [bar("A", d, d, 1) for d in range(120, 130)] + [bar("B", 63, 500, 1)],
        [bar("A", 118, 7, 2), bar("D", 5, 1, 2), bar(None, 5, 1, 2)],
        [bar(None, 6, 3, 3), bar("A", 118, 8, 1)],
    ]
    kinds = "Date string, Ticker string, Open double, High double, Low double, Close double, Volume long, ingested_at_utc string"

    def curated(path, read):
        return sorted(map(repr, read(spark, path).select(sorted(read(spark, path).columns)).collect()))

    for number, rows in enumerate(steps):
        tables.append_version(spark.createDataFrame(rows, kinds), f"{root}/raw")
        run = batch.run_increment(spark, f"{root}/raw", f"{root}/step")
        batch.run_transform(spark, f"{root}/raw", f"{root}/whole")
        assert run["rows_in"] == len(rows)
        assert curated(f"{root}/step", buckets.read) == curated(f"{root}/whole", lambda s, p: tables.read_table(s, p).rows)
    assert batch.run_increment(spark, f"{root}/raw", f"{root}/step")["rows_in"] == 0
