"""Heavy keys, one-pass silver, snapshots, layouts, incremental tables, stored profiles, many headers."""

import re

import pytest
from pyspark.sql import functions as F

from fieldgrant import DATASETS, Ledger, run_bronze, run_silver
from fieldgrant.operators import payments, profile
from fieldgrant.plans import bucketed, ledger as ledgers
from fieldgrant.plans.incremental import MasterTable
from fieldgrant.plans.master import build_master
from fieldgrant.plans.profiles import ProfileStore
from fieldgrant.sources import readers, sinks, snapshots
from fieldgrant.spec import SILVER_SCHEMA

SCHEMES = [s.raw_code for s in payments.SCHEMES[:5]] + ["other", "UNKNOWN"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    """Payments, a third of them of one beneficiary, with null texts and amounts."""
    rows = []
    for i in range(3_000):
        name = "hot" if i % 3 == 0 else None if i % 50 == 1 else "UNKNOWN" if i % 50 == 2 else f"b{i % 211}"
        amounts = [None if (i + k) % 17 == 0 else round(((i * 7919 + k * 104_729) % 100_000) / 100 - 100, 2) for k in range(3)]
        rows.append((name, f"m{i % 13}", "SPAIN", str(2020 + i % 3), SCHEMES[i % 7], *amounts))
    contract = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER_SCHEMA if f.name != "silver_created_at")
    return spark.createDataFrame(rows, contract).repartition(6).cache()


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


# --- heavy keys


def test_heavy_keys_are_those_with_many_rows(spark, silver):
    hot = [r["h"] for r in silver.filter("beneficiary = 'hot'").select(F.xxhash64("beneficiary").alias("h")).distinct().collect()]
    assert payments.heavy_keys(silver, ["beneficiary"]) == hot
    assert payments.heavy_keys(silver.filter("beneficiary LIKE 'b%'"), ["beneficiary"]) == []
    assert payments.heavy_keys(silver.limit(0)) == []


def test_heavy_keys_among_many(spark):
    """More keys than counters, and keys just above and well below the share."""
    data = spark.range(200_000).select(F.when(F.col("id") % 40 == 0, "a").when(F.col("id") % 40 == 1, "b").when(F.col("id") % 200 == 2, "c").otherwise(F.col("id").cast("string")).alias("k"))
    found = payments.heavy_keys(data, ["k"], tracked=1_024)
    want = {r["k"]: r["h"] for r in data.filter("k IN ('a', 'b', 'c')").select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert set(found) == {want["a"], want["b"]}


def test_salting_changes_no_row(spark, silver):
    want = rows(payments.merge_payments(silver))
    assert rows(payments.merge_payments_salted(silver)) == want
    every = [r["h"] for r in silver.select(F.xxhash64(*payments.MERGE_KEYS).alias("h")).distinct().collect()]
    for heavy in ([], every[:3], every, [12345]):
        assert rows(payments.merge_payments_salted(silver, salts=3, heavy=heavy)) == want
    assert payments.merge_payments_salted(silver.limit(0)).count() == 0


def test_only_heavy_keys_are_salted(spark, silver):
    cold = silver.filter("beneficiary <> 'hot'").repartition(200, "beneficiary")
    assert plan(payments.merge_payments_salted(cold, heavy=[])).count("Exchange") == plan(payments.merge_payments(cold)).count("Exchange")
    assert "pmod" in plan(payments.merge_payments_salted(silver)) and "pmod" not in plan(payments.merge_payments(silver))


# --- silver in one pass

HEADER = "Beneficiario;Municipio;Medida;FEAGA;FEADER;ImporteCofin\n"
SPAIN = DATASETS["SPAIN_2024"]


@pytest.fixture
def lake(spark, tmp_path):
    class Lake:
        bronze, silver = (str(tmp_path / n) for n in ("bronze", "silver"))
        ledger = Ledger(spark, str(tmp_path / "ledger"))

        def land(self, text, name="a.csv"):
            folder = tmp_path / "landing" / "SPAIN" / "2024_LANDING"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / name).write_bytes((HEADER + text).encode("iso-8859-1"))
            return run_bronze(spark, str(tmp_path / "landing"), self.bronze, self.ledger, "SPAIN", "2024")

        def names(self):
            return sorted(r.beneficiary for r in sinks.read_silver(spark, self.silver).collect())

        def metadata(self):
            return self.ledger.record("SILVER", "SPAIN", "2024").first().metadata

    return Lake()


@pytest.mark.parametrize("options", [{}, {"exact_grain": False}, {"unique_grain": True}])
def test_bronze_is_read_once(spark, lake, options):
    lake.land("".join(f"B{i};x;I.1;1;2;3\n" for i in range(50)))
    seen = spark.sparkContext.accumulator(0)

    def counted(df):
        def count(batches):
            for b in batches:
                seen.add(len(b))
                yield b

        return df.mapInPandas(count, df.schema)

    from dataclasses import replace

    assert run_silver(spark, lake.bronze, lake.silver, lake.ledger, replace(SPAIN, prepare=counted), **options).status == "processed"
    assert seen.value == 50
    assert lake.metadata()["rows"] == "50" and 48 <= int(lake.metadata()["grain_estimate"]) <= 52
    assert lake.metadata().get("repeated_grain") == (None if options.get("exact_grain") is False else "0")


def test_repeated_grain_keeps_silver_as_it_was(spark, lake):
    lake.land("Ana;x;I.1;1;2;3\n")
    assert run_silver(spark, lake.bronze, lake.silver, lake.ledger, SPAIN, unique_grain=True).status == "processed"
    lake.land("Eva;x;I.1;1;2;3\nEva;x;I.1;4;2;3\nEva;;I.1;4;2;3\nIda;;I.1;4;2;3\nIda;UNKNOWN;I.1;4;2;3\n", "b.csv")
    done = run_silver(spark, lake.bronze, lake.silver, lake.ledger, SPAIN, unique_grain=True)
    assert (done.status, done.reason) == ("failed", "unique grain: 2 repeated") and lake.names() == ["Ana"]
    assert run_silver(spark, lake.bronze, lake.silver, lake.ledger, SPAIN).status == "processed"
    assert lake.metadata()["repeated_grain"] == "2" and len(lake.names()) == 6


def test_repeated_grain_equals_duplicate_grain(spark):
    data = [(None, 0.0), (None, -0.0), ("a", 1.0), ("a", 1.0), ("a", 2.0), ("b", None), ("b", None), ("", None), (None, None)]
    df = spark.createDataFrame(data, "k string, v double")
    assert rows(profile.repeated_grain(df, ["k", "v"])) == rows(profile.duplicate_grain(df, ["k", "v"])) != []


# --- snapshots and the ledger


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "publish", "delete_paths", "half_deleted", "forget"])
def test_a_compaction_that_stops_loses_no_event(spark, tmp_path, monkeypatch, step):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    for i in range(2):
        ledger.mark_processed("BRONZE" if i % 2 else "SILVER", "X", "1", f"f{i}", {"n": i, "a": None})
    before = sorted(map(str, ledger.events().collect()))
    for turn in range(2):  # with and without an earlier snapshot

        def stop(*_, **__):
            raise Stopped

        with monkeypatch.context() as m:
            if step == "half_deleted":
                whole = snapshots.delete_paths
                m.setattr(ledgers, "delete_paths", lambda s, paths: (whole(s, paths[: len(paths) // 2]), stop()))
            elif step == "delete_paths":
                m.setattr(ledgers, "delete_paths", stop)
            else:
                m.setattr(ledger.snapshots, step, stop)
            with pytest.raises(Stopped):
                ledger.compact()
        assert sorted(map(str, ledger.events().collect())) == before
        assert ledger.events("BRONZE").count() == 1 + turn
        ledger.compact()
        assert sorted(map(str, ledger.events().collect())) == before
        ledger.mark_failed("BRONZE", "X", "1", "no disk")
        before = sorted(map(str, ledger.events().collect()))
        assert len(before) == 3 + turn and ledger.latest_processed("BRONZE", "X", "1") == "f1"


def test_events_appended_during_a_compaction_stay(spark, tmp_path, monkeypatch):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    ledger.mark_processed("BRONZE", "X", "1", "f0")
    publish = ledger.snapshots.publish

    def late(version):
        ledger.mark_processed("BRONZE", "Y", "1", "f1")
        publish(version)

    monkeypatch.setattr(ledger.snapshots, "publish", late)
    ledger.compact()
    assert sorted(r.dataset_id for r in ledger.events().collect()) == ["X_1", "Y_1"]


def test_snapshots(spark, tmp_path):
    kept = snapshots.Snapshots(spark, str(tmp_path / "a b"))
    assert kept.version() is None and kept.read("id long") is None
    kept.forget()
    versions = []
    for n in range(3):
        versions.append(kept.write(spark.range(n)))
        assert kept.version() == (versions[-2] if n else None)
        kept.publish(versions[-1])
        assert kept.read("id long").count() == n
    kept.forget(keep=2)
    assert kept.read("id long", version=versions[1]).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        kept.read("id long", version=versions[0])


# --- layout


def test_one_layout_serves_all_without_a_shuffle(spark, silver, tmp_path):
    # The taxonomy may be sent to all tasks; nothing else may hide a shuffle.
    name = "layout_of_test"
    laid = bucketed.layout_rows(silver).repartition(4, "beneficiary")
    assert laid.filter("beneficiary = 'hot'").count() <= len(SCHEMES)
    bucketed.write_layout(silver, name, str(tmp_path / "layout"), 4)
    try:
        held = spark.table(name)
        merged = payments.merge_payments(held)
        wide = payments.classify_schemes(payments.nonzero_payouts(payments.payout_totals(merged)))
        frames = [merged, payments.macro_totals(wide), payments.scheme_pivot(wide)]
        frames += [bucketed.bucketed_master(spark, name, join=join) for join in (False, True)]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for df in frames:
            assert re.findall(r"(?<!Broadcast)Exchange \w+", plan(df)) == [], plan(df)
        want = rows(build_master(silver))
        assert rows(frames[-1]) == want and rows(frames[-2]) == want
        assert rows(merged) == rows(payments.merge_payments(payments.identifiable_payouts(silver)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {name}")


def test_the_layout_is_written_by_one_shuffle(silver):
    assert plan(bucketed.layout_rows(silver, heavy=[]).repartition(4, "beneficiary")).count("Exchange hashpartitioning") == 1


# --- incremental master


def test_replaced_datasets_equal_a_rebuild(spark, silver, tmp_path):
    master = MasterTable(spark, str(tmp_path / "m"))
    assert master.master().count() == 0 and master.master().columns == build_master(silver).columns
    of = {y: silver.filter(F.col("year") == y) for y in ("2020", "2021", "2022")}
    held = {}

    def check(name, part, told=True):
        master.replace(name, part)
        held.pop(name, None)
        if part is not None:
            held[name] = part
        if not told:
            return
        whole = silver.limit(0)
        for p in held.values():
            whole = whole.union(p)
        assert rows(master.master()) == rows(build_master(whole))
        assert set(master.datasets()) == set(held)

    check("a", of["2020"], told=False)
    check("b", of["2021"])
    check("a", of["2020"].filter("beneficiary <> 'hot'"))
    check("b", of["2022"])
    check("c", of["2022"].withColumn("total_eagf_income_support", -F.col("total_eagf_income_support")))
    check("a", of["2020"].limit(0), told=False)
    check("c", None)


def test_a_replacement_that_stops_changes_nothing(spark, silver, tmp_path, monkeypatch):
    master = MasterTable(spark, str(tmp_path / "m"))
    master.replace("a", silver.filter("year = '2020'"))
    before = rows(master.master())

    def stop(_):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(master.snapshots, "publish", stop)
        with pytest.raises(Stopped):
            master.replace("b", silver.filter("year = '2021'"))
    assert rows(master.master()) == before and set(master.datasets()) == {"a"}
    master.replace("b", silver.filter("year = '2021'"))
    assert rows(master.master()) == rows(build_master(silver.filter("year <> '2022'")))


def test_one_contribution_is_not_grouped_again(spark, silver, tmp_path, monkeypatch):
    """A dataset that is added or taken out has its sums by key already; only a replaced one's are put together with its old ones."""
    master, grouped = MasterTable(spark, str(tmp_path / "m")), []
    monkeypatch.setattr(master, "_added", lambda *parts, plain=master._added: grouped.append(len(parts)) or plain(*parts))
    of = {y: silver.filter(F.col("year") == y) for y in ("2020", "2021")}
    for name, part, calls in (("a", of["2020"], 0), ("b", of["2021"], 1), ("a", of["2021"], 2), ("b", None, 1)):
        grouped.clear()
        master.replace(name, part)
        assert len(grouped) == calls
    assert rows(master.master()) == rows(build_master(of["2021"]))


# --- stored profiles


def test_merged_profiles_equal_a_rescan(spark, silver, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "p"))
    years = ("2020", "2021", "2022")
    for y in years:
        store.record(y, silver.limit(5))
        store.record(y, silver.filter(F.col("year") == y))
    exact = {r.column_name: r.distinct_count for r in profile.distinct_profile(silver).collect()}
    got = store.profile()
    assert rows(got.drop("distinct_estimate")) == rows(profile.missing_profile(silver))
    assert all(abs(r.distinct_estimate - exact[r.column_name]) <= 0.05 * exact[r.column_name] for r in got.collect())
    two = silver.filter("year <> '2022'")
    assert rows(store.profile(years[:2]).drop("distinct_estimate")) == rows(profile.missing_profile(two))


def test_profiles_of_many_values_and_of_none(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "p"))
    for n in range(4):
        store.record(str(n), spark.range(n * 20_000, (n + 2) * 20_000).withColumn("x", F.lit(None).cast("string")))
    got = {r.column_name: r for r in store.profile().collect()}
    assert abs(got["id"].distinct_estimate - 100_000) < 5_000 and got["id"].non_null_count == 160_000
    assert (got["x"].distinct_estimate, got["x"].missing_count) == (0, 160_000)
    store = ProfileStore(spark, str(tmp_path / "q"))
    store.record("none", spark.range(0))
    assert store.profile().first().missing_percentage is None


# --- many headers


def test_the_plan_does_not_follow_the_headers(spark, tmp_path):
    def read(n):
        folder = tmp_path / str(n)
        folder.mkdir()
        for i in range(n):
            (folder / f"f{i:03}.csv").write_bytes(f"k;Wért {i};v\n{i};a{i};é{i}\n;;\n".encode("iso-8859-1"))
        return readers.read_headed(spark, [str(folder / f"f{i:03}.csv") for i in range(n)])

    few, many = read(3), read(200)
    depth = [max(len(line) - len(line.lstrip(" :+-")) for line in plan(df).splitlines()) for df in (few, many)]
    assert depth[0] == depth[1] and plan(many).count("FileScan csv") == plan(few).count("FileScan csv") == 1
    assert many.columns[:2] == ["k", "wért_0"] and len(many.columns) == 202
    got = {r["k"]: r.asDict() for r in many.collect() if r["k"] is not None}
    assert len(got) == 200 and many.count() == 400
    assert all(r["v"] == f"é{k}" and r[f"wért_{k}"] == f"a{k}" and sum(v is not None for v in r.values()) == 3 for k, r in got.items())


def test_header_names_are_those_of_the_scan(spark, tmp_path):
    for n, header in enumerate(['a;b', ' A ; "B;b" ;c d', "a;;a;A;b", '"x ""y""";z', "a"]):
        (tmp_path / f"{n}.csv").write_text(header + "\n1;2;3;4;5\n")
        want = readers.normalise_columns(readers.read_delimited(spark, str(tmp_path / f"{n}.csv"))).columns
        if '""' not in header:
            assert readers.header_names(header) == want
    both = readers.read_headed(spark, [str(tmp_path / "0.csv"), str(tmp_path / "2.csv")])
    assert both.count() == 2


# --- what a task holds


def test_buckets_follow_the_table(spark, silver):
    assert bucketed.buckets_for(silver) == 8
    assert bucketed.buckets_for(silver, rows=100) == 30
    assert bucketed.buckets_for(silver.limit(0)) == 8


def test_headers_are_found_without_sorting_lines(spark, tmp_path, monkeypatch):
    for name, header in (("a", "\n \nX;Y"), ("b", "Z;Ñ"), ("c", "\n")):
        (tmp_path / f"{name}.csv").write_bytes(f"{header}\n1;2\n3;4\n".encode("latin-1") if name != "c" else b"\n")
    plans = []
    kept = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: plans.append(plan(df)) or kept(df))
    found = readers._headers(spark, [str(tmp_path / f"{n}.csv") for n in "abc"], "latin-1")
    assert sorted(found.values()) == ["X;Y", "Z;Ñ"]
    assert plans and "SortAggregate" not in "".join(plans)


def test_one_dataset_is_written_without_a_sort(spark, tmp_path, silver):
    """The write's job: rows of one dataset stay as they come; several datasets are still parted, and a dataset replaced alone."""
    path, rows_ = str(tmp_path / "silver"), silver.select("beneficiary", "country", "year")
    before = spark.conf.get(sinks._WRITERS, None)
    sinks.write_partitioned(rows_, path, sinks.SILVER_PARTITIONS)
    sinks.write_partitioned(rows_.filter("year = '2021'").limit(5), path, sinks.SILVER_PARTITIONS)
    assert spark.conf.get(sinks._WRITERS, None) == before
    held = {r["year"]: r["count"] for r in spark.read.parquet(path).groupBy("year").count().collect()}
    assert held == {2020: 1_000, 2021: 5, 2022: 1_000}
    with sinks._unsorted(spark):
        assert int(spark.conf.get(sinks._WRITERS)) >= 1


@pytest.mark.parametrize("module, query", [("runs", "relanded_empty"), ("lakes", "bronze_run_headers")])
def test_rows_landed_in_parts_are_computed_once(spark, monkeypatch, module, query):
    """The joins behind the landed rows are one computation, whatever number of files they are dealt to."""
    from fieldgrant.registered import QUERIES, lakes, runs

    computed, joined = [], runs.fixtures.bronze
    monkeypatch.setattr(runs, "materialise", lambda df, *args: computed.append(df) or spark.createDataFrame(df.limit(50).collect(), df.schema))
    monkeypatch.setattr(runs.fixtures, "bronze", lambda *args, **kw: joined(*args, **kw))
    assert {"runs": runs, "lakes": lakes}[module].QUERIES[query] is QUERIES[query]
    assert QUERIES[query](spark, "/root/testdata/sf0.001").count() > 0
    assert len(computed) == 1
