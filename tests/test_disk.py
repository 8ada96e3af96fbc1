"""Steps leave no files behind that nothing reads any more, and their narrower forms give what the wide ones gave."""

import os
import time
from urllib.parse import urlparse

from pyspark.sql import functions as F

from factweave.operators import grouping as G
from factweave.session import cut_lineage, drop_stored, scratch_dir
from tests.conftest import SF_SMALL


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def stored_tables(spark) -> set[str]:
    folder = urlparse(scratch_dir(spark)).path
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")))
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and df.count() == 7
    kept = stored_tables(spark)
    drop_stored(df)
    drop_stored(spark.range(1))  # not a stored one
    assert len(kept - stored_tables(spark)) == 1


SCHEMA = "gid string, batch int, tokens array<string>, " + ", ".join(f"{s} int" for s in G.SPANS) + ", url string, corpus string, confidence double"
PARTS = "gid string, batch int, arg1_fbid string, arg2_fbid string"


def test_regroup_takes_the_key_of_the_first_instance_and_drops_what_it_read(spark):
    """Groups whose instances have several keys, one with parts but no instances, one without parts, a NULL id."""
    rows = [(g, b, [a, "likes", m], 0, 1, 1, 1, 2, 1, u, "c", c) for g, b, a, m, u, c in [
        ("g1", 0, "Cat", "Milk", "u1", 0.5), ("g1", 0, "Dog", "Milk", "u2", None), ("g2", 3, "Dog", "Milk", "u3", -1.0), ("g2", 3, "Dog", "Milk", "u2", None),
        ("g3", 3, "Cow", None, "u4", 0.5), ("g4", 3, "Cat", "Milk", "u1", 0.5), (None, 3, "Cat", "Milk", "u9", 0.5)]]
    inst = spark.createDataFrame(rows, SCHEMA)
    parts = spark.createDataFrame([("g1", 0, None, None), ("g2", 3, "m.2", None), ("g3", 3, None, None), ("g5", 0, "m.5", None), (None, 0, "m.0", None)], PARTS)
    spent = cut_lineage(inst)
    before = stored_tables(spark)
    merged, head = G.regroup(spent, parts, ["url"], spent=(spent,))
    assert len(before - stored_tables(spark)) == 1  # the spent one
    assert merged.columns == [*G.KEY, "url", "inst_id"]
    wide, whole = G.regroup(inst, parts)
    assert wide.columns == [*G.KEY, *G.INSTANCE, "inst_id"]
    # the first instance by hash names the group, whatever the others' own keys are
    got = {(r.url, r.arg1, r.rel, r.arg2) for r in merged.collect()}
    assert got == {(r.url, r.arg1, r.rel, r.arg2) for r in wide.collect()}
    ids = {r.url: r.inst_id for r in wide.collect()}
    first = {"u1": "cat", "u2": "dog"}[min(("u1", "u2"), key=ids.get)]
    keys = {("u1", first), ("u2", first), ("u2", "dog"), ("u3", "dog"), ("u4", "cow"), ("u1", "cat")}
    assert {(u, a) for u, a, _, _ in got} == keys
    heads = {(r.arg1, r.arg1_fbid, r.first_batch, r.last_batch) for r in head.collect()}
    want = {("dog", "m.2", 0, 3), ("cow", None, 3, 3)} if first == "dog" else {("cat", None, 0, 0), ("dog", "m.2", 3, 3), ("cow", None, 3, 3)}
    assert heads == want == {(r.arg1, r.arg1_fbid, r.first_batch, r.last_batch) for r in whole.collect()}


def test_regroup_queries_store_no_names_and_drop_their_rows(spark):
    from factweave.plans import registry as R
    before = stored_tables(spark)
    R.inc1_upsert_groups(spark, SF_SMALL)
    left = [spark.read.parquet(f"{scratch_dir(spark)}/{t}").columns for t in stored_tables(spark) - before]
    assert left and not any({"tokens", "arg1_name", "batch"} & set(c) for c in left)


def test_links_are_looked_up_once_per_question(spark, monkeypatch):
    """Ten groups with two arguments and one context word between them ask four questions; parts may hold the fbids alone."""
    from factweave.operators import linking as L
    rows = [(f"k{i}", "r", "b", ["Blue", "ring", "by", "Peru" if i % 2 else "Chad", "Acme"], 0, 2, 2, 1, 4, 1, f"{i:032x}") for i in range(10)]
    inst = spark.createDataFrame([*rows, rows[0]], ", ".join(f"{k} string" for k in G.KEY) + ", tokens array<string>, " + ", ".join(f"{s} int" for s in G.SPANS) + ", inst_id string")
    anchors = spark.createDataFrame([("blue ring", "m.1", 3), ("blue ring", "m.2", 2), ("acme", "s.1", 1)], "anchor string, fbid string, link_count long")
    ents = spark.createDataFrame([(f, f, 1, ["/t"], c) for f, c in (("m.1", None), ("m.2", ["peru"]), ("s.1", []))],
                                 "fbid string, name string, inlinks long, types array<string>, context array<string>")
    parts = inst.select(*G.KEY).distinct().withColumn("arg1_fbid", F.lit("m.9")).withColumn("arg2_fbid", F.lit(None).cast("string"))
    asked, look_up = [], L.link_candidates
    monkeypatch.setattr(L, "link_candidates", lambda q, *a: (asked.append(q), look_up(q, *a))[1])
    out = {r.arg1: (r.arg1_fbid, r.arg1_score, r.arg2_fbid, r.arg2_score) for r in L.link_groups(inst, parts, anchors, ents).collect()}
    assert out == {f"k{i}": ("m.2", 4, "s.1", 1) if i % 2 else ("m.1", 3, "s.1", 1) for i in range(10)}
    assert asked[0].count() == 4 and not set(G.KEY) & set(asked[0].columns)


def test_rendering_drops_the_rows_it_read(spark):
    from factweave.plans import registry as R
    before = stored_tables(spark)
    R.pf10_render_groups(spark, SF_SMALL)
    left = [set(spark.read.parquet(f"{scratch_dir(spark)}/{t}").columns) for t in stored_tables(spark) - before]
    assert left and not any({"tokens", "arg1_fbid"} <= c for c in left)  # rows with both were read by two steps


def test_a_small_cap_stores_only_what_it_keeps(spark):
    """A hot key, NULL keys and repeated rows; ids as text or as bytes. Rows over the cap are dropped before the shuffle and stored nowhere."""
    rows = [("a" if i % 3 else None, "r", "b", i % 40, "u") for i in range(600)] + [("c", "r", None, 7, "u")] * 5
    df = spark.createDataFrame(rows, ", ".join(f"{k} string" for k in G.KEY) + ", v int, url string").withColumn("inst_id", F.md5(F.col("v").cast("string"))).drop("v")
    every = {(r.arg1, r.inst_id) for r in df.collect()}
    counts = {(r.arg1, r.inst_id): r["count"] for r in df.groupBy("arg1", "inst_id").count().collect()}
    want = set()
    for key in ("a", None, "c"):
        first = sorted(h for a, h in every if a == key for _ in range(counts[(a, h)]))[:20]
        want |= {(key, h) for h in first}
    before = stored_tables(spark)
    assert {(r.arg1, r.inst_id) for r in G.group_instances(df, max_group_size=20, columns=[]).collect()} == want
    left = [spark.read.parquet(f"{scratch_dir(spark)}/{t}").count() for t in stored_tables(spark) - before]
    assert left == [len(want)]
    held = G.group_instances(df.withColumn("inst_id", F.unhex("inst_id")), max_group_size=20, columns=["url"])
    assert {(r.arg1, bytes(r.inst_id).hex(), r.url) for r in held.collect()} == {(k, h, "u") for k, h in want}


def test_a_small_cap_limits_rows_before_its_only_shuffle(spark):
    from factweave.operators.caps import first_few_per_key
    df = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") < 900, "hot").alias("k"), F.md5((F.col("id") % 300).cast("string")).alias("h"), "id")
    got = first_few_per_key(df, ["k"], "h", 7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 1 and "WindowGroupLimit" in plan[plan.index("Exchange hash"):]
    hashes = sorted(r.h for r in df.filter("k = 'hot'").collect())
    assert sorted(r.h for r in got.collect() if r.k) == hashes[:7] and got.count() == 14 and got.columns == df.columns


def test_homes_are_merged_pass_by_pass(spark, monkeypatch, tmp_path):
    """A split home that still has files, NULL keys and urls, an instance in two batches: passes share no key and change no row, and no shuffle files stay."""
    from factweave.streaming import table as TB
    whole = TB.passes([TB.Home(1, 0, 5, 0, ()), TB.Home(1, 1, 5, 0, ()), TB.Home(2, 2, 5, 0, ()), TB.Home(3, 6, 5, 0, ()), TB.Home(2, 3, 5, 0, ())])
    assert len(whole) == 1
    monkeypatch.setattr(TB, "PASS_BYTES", 1)
    homes = [TB.Home(1, 1, 5, 0, ()), TB.Home(2, 0, 5, 0, ()), TB.Home(2, 2, 5, 0, ()), TB.Home(2, 3, 5, 0, ()), TB.Home(3, 5, 5, 0, ())]
    assert [[h.name for h in p] for p in TB.passes(homes)] == [["1-1", "2-3", "3-5"], ["2-0"], ["2-2"]] and TB.passes([]) == []

    table = str(tmp_path / "table")
    assert TB.table_summary(spark, table).count() == 0
    rows = [(f"a{i % 30}" if i % 7 else None, "r", "b", ["x"], *[0] * 6, f"u{i % 4}" if i % 5 else None, "c", i % 3 / 10, f"{i % 90:032x}") for i in range(120)]
    df = spark.createDataFrame(rows, TB.INSTANCE_SCHEMA)
    before = shuffle_files(spark)
    key = F.xxhash64(*G.KEY)
    for batch, depth in enumerate((1, 1, 2)):
        TB.append(spark, df.filter(F.col("tokens")[0] == "x"), table, "instances", batch, F.concat(F.lit(f"{depth}-"), key.bitwiseAND(F.lit((1 << depth) - 1)).cast("string")))
    parts = df.select(*G.KEY).distinct().withColumns({f.name: F.lit(None).cast(f.dataType) for f in TB.PART_SCHEMA.fields[3:]}).withColumn("gid", F.lit("g"))
    TB.append(spark, parts, table, "parts", 0, F.concat(F.lit("1-"), key.bitwiseAND(F.lit(1)).cast("string")))
    summary = lambda d: sorted(map(repr, d.select(*G.KEY, "n_instances", "n_urls", "max_conf", "min_conf").collect()))
    want = summary(G.group_summary(df.dropDuplicates([*G.KEY, "inst_id"])))
    assert summary(TB.table_summary(spark, table)) == want == summary(G.group_summary(TB.read_table(spark, table)[0]))
    read, real = [], TB.read_raw
    monkeypatch.setattr(TB, "read_raw", lambda s, t, name, only=None: (read.append((name, only)), real(s, t, name, only))[1])
    done = TB.compact(spark, table, ratio=0.0)
    seen = [n for name, only in read if name == "instances" for n in only]
    assert sorted(seen) == sorted(done) and sum(name == "instances" for name, _ in read) == 2  # a family at a time
    assert not {(h.depth, h.bits) for h in TB.homes(spark, table)} & TB.split_homes(TB.homes(spark, table))
    assert summary(TB.table_summary(spark, table)) == want
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        spark._jvm.System.gc()
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
