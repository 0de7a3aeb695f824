"""Layout: statistics only on the chosen columns; Z-order and clustering let a point
lookup skip files by footer min/max; rows never change."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from strata.operators.layout import Layout, zorder_code
from strata.plans.common import setup
from strata.plans.finance import enrich_lines


def _files(path):
    path = str(path).removeprefix("file:")
    return [f for f in glob.glob(f"{path}/**/*.parquet", recursive=True)]


def _stats_columns(f):
    md = pq.ParquetFile(f).metadata
    rg = md.row_group(0)
    return {rg.column(i).path_in_schema for i in range(rg.num_columns) if rg.column(i).is_stats_set}


def test_stats_only_on_chosen_columns(spark, tmp_path):
    from conftest import SMALL
    t, _ = setup(spark, SMALL)
    lay = Layout(stats_columns=("o_orderdate", "o_custkey"))
    t.orders.write.options(**lay.writer_options(t.orders.columns)).parquet(str(tmp_path / "o"))
    files = _files(str(tmp_path / "o"))
    assert files and all(_stats_columns(f) == {"o_orderdate", "o_custkey"} for f in files)


def _files_hit(path, col, value):
    hit = 0
    for f in _files(path):
        md = pq.ParquetFile(f).metadata
        for g in range(md.num_row_groups):
            rg = md.row_group(g)
            idx = [rg.column(i).path_in_schema for i in range(rg.num_columns)].index(col)
            s = rg.column(idx).statistics
            if s is None or (s.min <= value <= s.max):
                hit += 1
                break
    return hit


def test_zorder_and_cluster_skip_files(spark, tmp_path):
    from conftest import MEDIUM
    t, _ = setup(spark, MEDIUM)
    df = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    plain = str(tmp_path / "plain")
    z = str(tmp_path / "z")
    df.repartition(16).write.parquet(plain)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        Layout(zorder_by=("l_partkey", "l_suppkey")).arrange(df).write.parquet(z)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert spark.read.parquet(z).count() == df.count()
    probe = df.select("l_partkey", "l_suppkey").first()
    zp, zs = _files_hit(z, "l_partkey", probe[0]), _files_hit(z, "l_suppkey", probe[1])
    pp, ps = _files_hit(plain, "l_partkey", probe[0]), _files_hit(plain, "l_suppkey", probe[1])
    assert zp < pp and zs < ps


def test_zorder_code_is_deterministic_and_bounded(spark):
    from conftest import SMALL
    t, _ = setup(spark, SMALL)
    code = zorder_code(t.lineitem, ["l_partkey", "l_shipdate"], bits=4)
    r = t.lineitem.select(code.alias("c")).agg(F.min("c"), F.max("c")).first()
    assert r[0] >= 0 and r[1] < 2 ** 8


def test_clustered_view_keeps_rows(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    s = enrich_lines(t.lineitem, t.orders, t.customer, t.part)
    out = ws.materialized_view("c", s, cluster_by=("order_date", "customer_id", "item_id"))
    assert out.count() == s.count()
    assert out.exceptAll(s).count() == 0


def test_optimize_write_makes_fewer_files(spark):
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    s = enrich_lines(t.lineitem, t.orders, t.customer, t.part).repartition(32)
    ws.materialized_view("plain", s)
    ws.materialized_view("opt", s, properties={"delta.autoOptimize.optimizeWrite": "true"})
    n_plain = len(_files(ws.data_path("plain")))
    n_opt = len(_files(ws.data_path("opt")))
    assert n_opt < n_plain
    assert ws.read("opt").count() == ws.read("plain").count()


def test_each_of_three_cluster_keys_skips_most_files(spark, tmp_path):
    from conftest import MEDIUM
    t, _ = setup(spark, MEDIUM)
    df = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_partkey", "l_shipdate", "p_name")
    keys, path = ("l_orderkey", "l_shipdate", "p_name"), str(tmp_path / "c")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        Layout(cluster_by=keys).arrange(df).write.parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    n = len(_files(path))
    rows = df.orderBy(F.xxhash64(*df.columns)).limit(10).collect()
    for k in ("l_orderkey", "l_shipdate"):
        hits = [_files_hit(path, k, r[k]) for r in rows]
        assert sum(hits) / len(hits) < n / 2, (k, n, hits)


def test_statistics_on_the_first_32_columns_by_default(spark, tmp_path):
    wide = spark.range(10).select(*[F.col("id").alias(f"c{i}") for i in range(40)])
    wide.write.options(**Layout.from_properties({}).writer_options(wide.columns)).parquet(str(tmp_path / "w"))
    assert all(_stats_columns(f) == {f"c{i}" for i in range(32)} for f in _files(str(tmp_path / "w")))


def test_codes_are_small_expressions_and_right(spark):
    from conftest import SMALL
    from strata.operators.layout import quantile_cuts
    t, _ = setup(spark, SMALL)
    keys = ["l_orderkey", "l_shipdate", "l_extendedprice"]
    df = t.lineitem.withColumn("l_shipdate", F.when(F.col("l_linenumber") != 3, F.col("l_shipdate")))
    code = zorder_code(df, keys)
    plan = df.select(code.alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 40000
    cuts, bits = quantile_cuts(df, keys), 20
    num = {"l_orderkey": lambda v: float(v), "l_extendedprice": lambda v: float(v), "l_shipdate": None}

    def rank(x, c):
        c = sorted(set(c))
        if x is None:
            return 0
        a = max(0, min(len(c) - 2, sum(x >= e for e in c[:-1]) - 1))
        share = (a + min(max((x - c[a]) / (c[a + 1] - c[a]), 0), 1)) / (len(c) - 1)
        return min(int(share * (1 << bits)), (1 << bits) - 1)

    from strata.operators.layout import _numeric
    rows = df.select(*[_numeric(df, k).alias(k) for k in keys], code.alias("code")).collect()
    assert num and len({r.code for r in rows}) > 1000
    for r in rows[::7]:
        ranks = [rank(r[k], c) for k, c in zip(keys, cuts)]
        assert r.code == sum((v >> b & 1) << (b * 3 + i) for i, v in enumerate(ranks) for b in range(bits))


def test_the_deepest_files_are_chosen():
    from strata.operators.layout import deepest
    tiles = [(k * 10, k * 10 + 9) for k in range(50)]
    assert deepest(tiles, 1) == [] and deepest([], 1) == [] and deepest([(5, 5)] * 9, 1) == []
    wide = [(0, 499)] * 3
    assert deepest(tiles + wide, 1) == [50, 51, 52] and len(deepest(tiles + wide, 2)) == 2
    picked = deepest(tiles + [(95, 125)], 1)
    assert picked == [50]  # the one that overlaps, not those it lies over


def test_a_key_change_rewrites_few_files_and_lookups_skip(spark):
    from strata.plans.workspace import Workspace
    ws, n = Workspace(spark), 60000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("a"), (F.col("id") * 104729 % n).alias("b"), "id")
    path = f"{ws.root}/files/in"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def arrive(cond, keys):
        rows.where(cond).write.mode("append").parquet(path)
        with ws.update():
            ws.streaming_table("t", cluster_by=keys)
            ws.append_flow("t", "t", spark.readStream.schema(rows.schema).parquet(path))

    def hits(column, files):
        probe = rows.select(column).where("id % 6000 = 17").collect()
        stats = [pq.ParquetFile(f).metadata for f in files]
        at = [c.path_in_schema for c in (stats[0].row_group(0).column(i) for i in range(stats[0].num_columns))].index(column)
        spans = [[(m.row_group(g).column(at).statistics.min, m.row_group(g).column(at).statistics.max) for g in range(m.num_row_groups)] for m in stats]
        return sum(any(lo <= p[0] <= hi for lo, hi in s) for s in spans for p in probe) / len(probe)

    live = lambda: [r.file.removeprefix("file:").replace("//", "/") for r in spark.read.parquet(ws.catalog["t"].clustered["manifest"]).collect()]
    try:
        arrive(F.col("id") % 10 == 0, ("a",))
        arrive(F.col("id") % 10 > 0, ("b",))  # most rows are written by the new key
        done = ws.cluster("t", depth=1, rows_per_file=1500)
        assert done["files"] == 16 and done["rewritten"] == 8  # those of the old key
        after = hits("b", live())
        assert ws.read("t").count() == n and ws.read("t").exceptAll(rows).count() == 0
        again = ws.cluster("t", depth=2, rows_per_file=1500)
        assert again["rewritten"] == 0
        arrive(F.lit(False), ("b",))
        whole = ws.compact("t")
        assert after <= 2 * hits("b", [f.removeprefix("file:").replace("//", "/") for f in whole.inputFiles()]) + 0.01
        assert whole.count() == n and ws.catalog["t"].clustered == {}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_clustering_a_view_and_a_second_session(spark):
    from strata.plans.workspace import Workspace
    ws = Workspace(spark)
    rows = spark.range(5000).select("id", (F.col("id") * 7919 % 5000).alias("x"))
    with ws.update():
        ws.materialized_view("v", rows.repartition(6))
        ws.catalog["v"].cluster_by = ["x"]
    done = ws.cluster("v", depth=1, rows_per_file=1000)
    assert done["rewritten"] >= 5 and ws.read("v").exceptAll(rows).count() == 0
    other = Workspace(spark, root=ws.root)
    assert other.read("v").count() == 5000
    ws.materialized_view("v", rows.where("id < 10"))
    assert ws.read("v").count() == 10


def test_very_many_partitions_are_ranges_of_files(spark, tmp_path, monkeypatch):
    """Partitions get a folder each up to a number of them; beyond it the files do not become
    as many as the values, and readers still skip the files of other partitions."""
    from strata.operators import layout as lay
    monkeypatch.setattr(lay, "MOST_FOLDERS", 20)
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    want = sorted(map(str, rows.collect()))
    kinds = {"many": ("o_custkey", {}), "z": ("o_custkey", {"pipelines.autoOptimize.zOrderCols": "o_orderkey, o_orderdate"}), "few": ("o_orderpriority", {})}
    for name, (by, props) in kinds.items():
        path = f"{ws.root}/files/{name}"
        for k in range(2):
            rows.where(F.col("o_orderkey") % 2 == k).write.mode("append").parquet(path)
            with ws.update():
                ws.streaming_table(name, partition_by=[by], properties=props)
                ws.append_flow(name, name, spark.readStream.schema(rows.schema).parquet(path))
        assert sorted(map(str, ws.read(name).select(rows.columns).collect())) == want
        files = glob.glob(ws.data_path(name).removeprefix("file:") + "/**/*.parquet", recursive=True)
        assert any(f"{by}=" in f for f in files) == (name == "few")
        if name != "few":
            assert len(files) <= 2 * 8
        view = ws.materialized_view(f"mv_{name}", rows, partition_by=[by])
        assert sorted(map(str, view.select(rows.columns).collect())) == want
        assert sorted(map(str, ws.compact(name).select(rows.columns).collect())) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        Layout(partition_by=("o_custkey",)).write(rows, str(tmp_path / "ranges"), False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stats = [pq.ParquetFile(f).metadata.row_group(0).column(1).statistics for f in glob.glob(str(tmp_path / "ranges/*.parquet"))]
    assert len(stats) > 4 and sum(s.min <= 70 <= s.max for s in stats) <= 2


def test_a_table_with_folders_keeps_them(spark, monkeypatch):
    from strata.operators import layout as lay
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    rows = t.orders.select("o_orderkey", "o_custkey")
    path = f"{ws.root}/files/o"
    for k in range(2):
        rows.where(F.col("o_orderkey") % 2 == k).write.mode("append").parquet(path)
        with ws.update():
            ws.streaming_table("t", partition_by=["o_custkey"])
            ws.append_flow("t", "t", spark.readStream.schema(rows.schema).parquet(path))
        monkeypatch.setattr(lay, "MOST_FOLDERS", 20)
    assert all("o_custkey=" in f for f in ws.read("t").inputFiles())
    assert sorted(map(str, ws.read("t").collect())) == sorted(map(str, rows.collect()))


def test_a_plain_flow_runs_its_plan_once_and_keeps_nothing_in_memory(spark, monkeypatch):
    from pyspark.sql import DataFrame
    from conftest import SMALL
    t, ws = setup(spark, SMALL)
    rows = t.orders.select("o_orderkey", "o_custkey")
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: (_ for _ in ()).throw(AssertionError("persisted")))
    counts = {}
    i = ws.streaming_table("p", rows.schema)
    ws._flow_writer(i, "f", [], counts)(rows, 0)
    assert counts["out"] == rows.count() == ws.read("p").count()


def test_codes_are_worked_out_by_the_batch(spark):
    """No function runs row by row inside the code's expression (``transform`` is not compiled);
    NULL has the smallest code, NaN the greatest."""
    rows = spark.range(1000).select(F.expr("CASE WHEN id = 7 THEN NULL WHEN id = 8 THEN double('nan') ELSE double(id) END").alias("x"), "id")
    code = zorder_code(rows, ["x", "id"])
    plan = rows.select(code.alias("c"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "transform(" not in plan
    by_x = {r["id"]: r["c"] for r in rows.select("id", zorder_code(rows, ["x"]).alias("c")).collect()}
    assert by_x[7] == 0 == min(by_x.values()) and by_x[8] == (1 << 20) - 1
    assert all(by_x[k] < by_x[k + 1] for k in range(9, 998))
