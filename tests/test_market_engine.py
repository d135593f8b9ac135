"""What the market engine adds to Spark: hours side by side, swaps by a journal, global ranks, boosting, races, stored models."""

import datetime as dt
import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gridlake.operators import incremental, ranking, swap
from gridlake.plans import boosting, forecast, hourly, marts, model_store, registry, staging
from gridlake.plans.oracles import AS_OF
from gridlake.sources import files, shared
from gridlake.sources.bindings import Silver
from gridlake.streaming import market as streams

D = dt.date
HOURLY = ["pricing", "interim_mcp", "smf", "generation", "unlicensed_generation", "load_estimation", "load_vs_actual", "res_forecast", "aic", "dpp", "dam_clearing", "order_up", "order_down", "system_direction", "imbalance", "price_ind_bid"]


def test_hours_side_by_side_are_the_staged_tables(spark, sf):
    lake = registry.lake_of(spark, sf)
    wide = hourly.bucketed(hourly.market_hours(lake, *HOURLY))
    assert wide.groupBy("date", "hour").count().where("count > 1").count() == 0
    for name in HOURLY:
        told = {tuple(r) for r in wide.where(F.col(name).isNotNull()).select("date", "hour", f"{name}.*").collect()}
        columns = wide.select("date", "hour", f"{name}.*").columns
        plain = lambda rows: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in rows)
        assert plain(told) == plain(tuple(r) for r in lake[name].select(columns).collect()), name


def test_bucketed_hours_join_without_an_exchange(spark):
    rows = spark.createDataFrame([(D(2025, 1, 1 + i // 24), i % 24, float(i)) for i in range(100)], "date date, hour int, v double")
    a, b = hourly.bucketed(rows), hourly.bucketed(rows.withColumnRenamed("v", "w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = a.join(b, ["date", "hour"])
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString() and both.where("v = w").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# Swaps


class Stopped(Exception):
    pass


def _stop_at(monkeypatch, n):
    """The n-th change of the file system doesn't happen; returns how many were asked for."""
    asked = [0]

    def guarded(do):
        def step(*args):
            asked[0] += 1
            if asked[0] == n:
                raise Stopped
            return do(*args)

        return step

    for name in ("move", "delete", "put_text"):
        monkeypatch.setattr(files, name, guarded(getattr(files, name)))
    return asked


def test_a_swap_that_stops_anywhere_loses_no_row(spark, tmp_path, monkeypatch):
    schema = "date date, hour int, v double"
    first = [(D(2025, 1, 1), 0, 1.0), (D(2025, 1, 1), 1, 2.0), (D(2025, 1, 2), 0, 3.0), (D(2025, 1, 3), 0, 4.0)]
    news = [(D(2025, 1, 1), 1, 9.0), (D(2025, 1, 3), 0, 8.0), (D(2025, 1, 4), 0, 7.0)]
    old = sorted(first)
    new = sorted([first[0], first[2], *news])
    rows = lambda path: sorted((r["date"], r["hour"], r["v"]) for r in swap.read(spark, path).collect())
    seen, n, finished = set(), 0, False
    while not finished:
        n += 1
        path = f"{tmp_path}/t{n}"
        incremental.replace_partitions(spark.createDataFrame(first, schema).coalesce(1), path)
        with monkeypatch.context() as patch:
            _stop_at(patch, n)
            try:
                incremental.upsert(spark.createDataFrame(news, schema).coalesce(1), path, ["date", "hour"])
                finished = True
            except Stopped:
                pass
        state = rows(path)
        assert state in (old, new), n
        seen.add(state == new)
        # A reader changes nothing; the next write finishes or undoes what was begun.
        assert rows(path) == state
        swap.recover(spark, path)
        assert rows(path) == state == sorted(map(tuple, spark.read.parquet(path).select("date", "hour", "v").collect()))
        assert not files.matching(spark, f"{path}-*")
    assert seen == {True, False} and n > 8


def test_a_stopped_delete_is_finished_by_the_next_write(spark, tmp_path, monkeypatch):
    path, schema = f"{tmp_path}/d", "date date, hour int, v double"
    incremental.replace_partitions(spark.createDataFrame([(D(2025, 1, 1), 0, 1.0), (D(2025, 1, 2), 0, 2.0), (D(2025, 1, 2), 1, 3.0)], schema), path)
    gone = spark.createDataFrame([(D(2025, 1, 1), 0), (D(2025, 1, 2), 1)], "date date, hour int")
    with monkeypatch.context() as patch:
        asked = _stop_at(patch, 4)
        with pytest.raises(Stopped):
            incremental.delete_matching(path, gone, ["date", "hour"])
    assert asked[0] == 4
    assert [tuple(r) for r in swap.read(spark, path).select("date", "hour", "v").collect()] == [(D(2025, 1, 2), 0, 2.0)]
    incremental.upsert(spark.createDataFrame([(D(2025, 1, 5), 0, 5.0)], schema), path, ["date", "hour"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2.0, 5.0]


def test_an_older_row_never_replaces_a_newer_one(spark, tmp_path):
    """A correction that arrived first comes in a later batch."""
    source, path, check, schema = f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/c", "date date, hour int, price double, arrived int"
    batches = [[(D(2025, 1, 1), 0, 20.0, 2), (D(2025, 1, 1), 1, 5.0, 1)], [(D(2025, 1, 1), 0, 10.0, 1), (D(2025, 1, 1), 1, 6.0, 3)], [(D(2025, 1, 1), 1, 7.0, 2), (D(2025, 1, 2), 0, 1.0, 1)]]
    for batch in batches:
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        # Each call goes on from the checkpoint.
        streams.upsert_stream(spark.readStream.schema(schema).parquet(source), path, ["date", "hour"], check).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(path).select("date", "hour", "price", "arrived").collect())) == [(D(2025, 1, 1), 0, 20.0, 2), (D(2025, 1, 1), 1, 6.0, 3), (D(2025, 1, 2), 0, 1.0, 1)]


def test_keyed_state_outlives_restarts_and_out_of_order_batches(spark, tmp_path):
    """Each call is a new query that goes on from the checkpoint; the state, not the table, tells old from new."""
    schema = "date date, hour int, at timestamp, price double, arrived int"
    rng, day = random.Random(9), dt.datetime(2025, 1, 1)
    rows = [(D(2025, 1, 1), h, day + dt.timedelta(hours=h), round(rng.random(), 6), n) for h in range(6) for n in rng.sample(range(1, 40), 8)]
    rng.shuffle(rows)
    told, firsts, calls = [], [], [rows[:17], rows[17:20], rows[20:]]
    for batch in calls:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        streams.keyed_upsert_stream(stream, f"{tmp_path}/table", ["date", "hour"], f"{tmp_path}/c1").awaitTermination()
        for seen, df, at in ((told, streams.newest_corrections(stream, ["date", "hour"]), "c2"), (firsts, streams.first_predictions(stream, ["date", "hour"], "arrived"), "c3")):
            mode = "update" if seen is told else "append"
            df.writeStream.foreachBatch(lambda b, _, seen=seen: seen.append(sorted(map(tuple, b.collect())))).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{at}").trigger(availableNow=True).start().awaitTermination()
    newest = {h: max(r[4] for r in rows if r[1] == h) for h in range(6)}
    table = {r["hour"]: r["arrived"] for r in spark.read.parquet(f"{tmp_path}/table").collect()}
    assert table == newest
    emitted = [r for batch in told for r in batch]
    for h in range(6):
        places = [r[4] for r in emitted if r[1] == h]
        assert places == sorted(set(places)) and places[-1] == newest[h]
    first_call = {h: min((i for i, b in enumerate(calls) if any(r[1] == h for r in b))) for h in range(6)}
    kept = [r for batch in firsts for r in batch]
    assert sorted(r[1] for r in kept) == list(range(6))
    assert all(r[4] == min(x[4] for x in calls[first_call[r[1]]] if x[1] == r[1]) for r in kept)


# Ranks


def test_ranks_and_running_totals(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1.0, 2.0, rng.random()]), i, rng.randrange(5)) for i in range(5000)]
    table = spark.createDataFrame(rows, "s double, i int, n int").repartition(7)
    got = ranking.ranked(table, [F.col("s"), F.col("i").desc()]).collect()
    assert {r["i"]: r["rank"] for r in got} == {i: k for k, (_, i, _) in enumerate(sorted(rows, key=lambda r: (r[0], -r[1])), 1)}
    tied = ranking.ranked(table.withColumn("s", F.lit(1)), [F.col("s")]).collect()
    assert sorted(r["rank"] for r in tied) == list(range(1, 5001))
    total, want = 0, {}
    for _, i, n in sorted(rows, key=lambda r: (r[0], r[1])):
        want[i], total = total, total + n
    assert {r["i"]: r["n_before"] for r in ranking.running_total(table, [F.col("s"), F.col("i")], "n").collect()} == want
    assert ranking.ranked(table.where("false"), [F.col("s")]).count() == 0


def test_one_tied_value_is_cut_into_ranges(spark):
    stored = []
    ranking.ranked(spark.range(40_000).select(F.lit(7).alias("s")), [F.col("s")], write=lambda df: stored.append(df.cache()) or stored[0]).count()
    sizes = [r["count"] for r in stored[0].groupBy(F.shiftright("_rank_at", 33).alias("part")).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 30_000


def test_area_under_the_curve_of_clumped_scores(spark):
    """A million scores, 99 % of them within one part in 10,000: exact, and no range has most of them."""
    table = spark.range(1_000_000).select("id", F.when(F.col("id") % 100 == 0, F.col("id") / 1e6).otherwise(0.5 + F.pmod(F.col("id") * 7919, F.lit(999_983)) / 1e10).alias("s"), (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("y"))
    rows = sorted((r["s"], r["y"]) for r in table.collect())
    rank_sum, i = 0.0, 0
    while i < len(rows):
        j = i
        while j < len(rows) and rows[j][0] == rows[i][0]:
            j += 1
        rank_sum += sum(y for _, y in rows[i:j]) * (i + 1 + j) / 2
        i = j
    p = sum(y for _, y in rows)
    assert abs(forecast.rank_auc(table, "s", F.col("y")).first()[0] - (rank_sum - p * (p + 1) / 2) / (p * (len(rows) - p))) < 1e-12


# Sketches


def test_sketches_of_days_merge_to_one_pass(spark, tmp_path):
    from gridlake.operators import sketches

    rng = random.Random(12)
    values = [round(rng.gauss(100, 30), 4) for _ in range(60_000)]
    table = spark.createDataFrame([(D(2025, 1 + i % 3, 1 + i % 28), v) for i, v in enumerate(values)], "date date, v double").repartition(6)
    shares = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    ordered = sorted(values)
    rank = lambda v: sum(x <= v for x in ordered) / len(ordered)
    days = sketches.made(table, "v", ["date"], 512)
    merged = sketches.merged(days, [], 512).select(sketches.quantiles(shares), "n", "total").first()
    once = sketches.made(table, "v", [], 512).select(sketches.quantiles(shares)).first()[0]
    assert merged["n"] == len(values) and merged["total"] == pytest.approx(sum(values))
    for share, a, b in zip(shares, merged[0], once):
        assert abs(rank(a) - share) <= 2.3 / 512 * 2 and abs(rank(b) - share) <= 2.3 / 512 * 2
    # As long as a sketch holds all its values, quantiles are those of the values.
    small = spark.createDataFrame([(D(2025, 1, 1 + i % 5), float(i * 37 % 1001)) for i in range(1001)], "date date, v double")
    got = sketches.merged(sketches.made(small, "v", ["date"]), []).select(sketches.quantiles(shares)).first()[0]
    assert got == [float(max(0, math.ceil(s * 1001) - 1)) for s in shares]
    # Kept sketches: a day's news replace that day's sketch and leave the others.
    path = f"{tmp_path}/sketches"
    sketches.kept(small, "v", path)
    again = sketches.kept(spark.createDataFrame([(D(2025, 1, 2), 5000.0)], "date date, v double"), "v", path)
    assert {r["date"].day: r["n"] for r in again.collect()} == {1: 201, 2: 1, 3: 200, 4: 200, 5: 200}
    assert sketches.merged(again, []).select(sketches.quantiles([1.0])).first()[0] == [5000.0]


# Boosting


def plain_boosting(rows, features, k, bins, rounds, depth, rate, smooth=1.0):
    """Rows of (features, class, weight, valid), boosted row by row."""
    learned = [r for r in rows if not r[3]]
    edges = []
    for f in range(features):
        values = sorted(r[0][f] for r in learned)
        edges.append(sorted({values[max(0, math.ceil(len(values) * i / bins) - 1)] for i in range(1, bins)}))
    binned = [[sum(e < x for e in edges[f]) for f, x in enumerate(r[0])] for r in rows]
    weight = [sum(r[2] for r in learned if r[1] == c) for c in range(k)]
    raw = [[math.log(max(w / sum(weight), 1e-6)) for w in weight] for _ in rows]
    losses, splits = [], []
    for _ in range(rounds):
        p = [[math.exp(x - max(s)) for x in s] for s in raw]
        p = [[x / sum(q) for x in q] for q in p]
        g = [[r[2] * (q[c] - (r[1] == c)) for c in range(k)] for r, q in zip(rows, p)]
        h = [[r[2] * q[c] * (1 - q[c]) for c in range(k)] for r, q in zip(rows, p)]
        node = [0] * len(rows)
        for level in range(depth):
            best = None
            for f in range(features):
                for b in range(len(edges[f])):
                    gain = 0.0
                    for n in range(1 << level):
                        inside = [i for i, r in enumerate(rows) if node[i] == n and not r[3]]
                        left = [i for i in inside if binned[i][f] <= b]
                        for c in range(k):
                            a, ah, w, wh = (sum(v[i][c] for i in some) for some, v in ((left, g), (left, h), (inside, g), (inside, h)))
                            gain += a * a / (ah + smooth) + (w - a) ** 2 / (wh - ah + smooth) - w * w / (wh + smooth)
                    if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                        best = (gain, f, b)
            if best is None:
                break
            splits.append(best[1:])
            node = [n | (binned[i][best[1]] > best[2]) << level for i, n in enumerate(node)]
        for n in set(node):
            inside = [i for i in range(len(rows)) if node[i] == n]
            for c in range(k):
                value = -rate * sum(g[i][c] for i in inside if not rows[i][3]) / (sum(h[i][c] for i in inside if not rows[i][3]) + smooth)
                for i in inside:
                    raw[i][c] += value
        p = [[math.exp(x - max(s)) for x in s] for s in raw]
        held = [-math.log(q[r[1]] / sum(q)) for r, q in zip(rows, p) if r[3]]
        losses.append(sum(held) / len(held))
    return splits, losses, [[x / sum(q) for x in q] for q in p]


def _table(spark, n=240, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.random(), rng.random(), float(rng.randrange(4))]
        c = (x[0] > 0.6) + (x[2] > 1 and x[1] > 0.3) if rng.random() < 0.85 else rng.randrange(3)
        rows.append((x, int(c), rng.choice([1.0, 2.0]), i % 4 == 3))
    return rows, spark.createDataFrame([(i, *x, "abc"[c], w, v) for i, (x, c, w, v) in enumerate(rows)], "i int, f0 double, f1 double, f2 double, y string, w double, v boolean").repartition(5)


def test_boosting_as_plain(spark):
    rows, table = _table(spark)
    model = boosting.fit(table, ["f0", "f1", "f2"], ["a", "b", "c"], "y", "w", F.col("v"), rounds=4, depth=2, bins=8, patience=99)
    splits, losses, probabilities = plain_boosting(rows, 3, 3, 8, 4, 2, 0.3)
    assert [s for t in model.trees for s in zip(t["feature"], t["bin"])][: len(splits)] == splits[: 2 * len(model.trees)]
    assert model.losses == pytest.approx(losses)
    if len(model.trees) == 4:
        told = {r["i"]: [r["pa"], r["pb"], r["pc"]] for r in boosting.score(table, model, ["pa", "pb", "pc"], "said").collect()}
        assert all(told[i] == pytest.approx(p) for i, p in enumerate(probabilities))


def test_boosting_ends_at_the_best_validation_round(spark):
    _, table = _table(spark, 120)
    model = boosting.fit(table, ["f0", "f1", "f2"], ["a", "b", "c"], "y", None, F.col("v"), rounds=25, rate=0.9, patience=3)
    best = model.losses.index(min(model.losses))
    assert len(model.trees) == best + 1 and (len(model.losses) == 25 or len(model.losses) == best + 4)
    assert boosting.Boosted.from_json(model.to_json()) == model
    none = boosting.fit(table.where("false"), ["f0"], ["a", "b"], "y")
    assert none.trees == [] and boosting.score(table.limit(1), none, ["pa", "pb"], "said").collect()[0]["pa"] == 0.5


def test_labels_of_validation_rows_are_never_learned(spark):
    """Turned labels in the validation block change when boosting stops, never a tree that it grows."""
    _, table = _table(spark)
    turned = table.withColumn("y", F.when(F.col("v"), F.translate("y", "abc", "cab")).otherwise(F.col("y")))
    one, other = (boosting.fit(t, ["f0", "f1", "f2"], ["a", "b", "c"], "y", "w", F.col("v"), rounds=3, depth=2) for t in (table, turned))
    n = min(len(one.trees), len(other.trees))
    assert n and one.trees[:n] == other.trees[:n] and one.losses != other.losses


@pytest.fixture(scope="module")
def features(spark):
    lake = registry.lake_of(spark, "/root/testdata/sf0.01")
    from gridlake.plans.model_queries import _rows

    return _rows(lake)


def test_boosted_direction_beats_yesterday_and_the_forest(features):
    from gridlake.plans.model_queries import _beats

    told = {r["model"]: r for r in _beats(features).collect()}
    assert told["boosted"]["macro_f1"] > told["yesterday"]["macro_f1"] and told["boosted"]["accuracy"] > told["yesterday"]["accuracy"]
    assert told["boosted"]["macro_f1"] >= told["forest"]["macro_f1"]


def test_price_boosting_stops_early_and_sees_no_later_day(features):
    rows = forecast.early_stopping(features, rounds=30, validation_days=5).orderBy("round").collect()
    assert 1 <= len(rows) == rows[0]["rounds_used"] <= 30 and all(r["fitted_until"] < r["validated_from"] for r in rows)
    assert all(r["validation_error"] >= 0 for r in rows)


def test_the_race_finds_what_the_whole_grid_finds(spark):
    """A table whose classes take two splits, so that sets differ by more than noise."""
    noise = [F.rand(i).alias(c) for i, c in enumerate(forecast.DIRECTION_FEATURES)]
    hours = spark.range(60 * 24).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 24).cast("int")).alias("date"), (F.col("id") % 24).cast("int").alias("hour"), F.lit(1.0).alias("smf_try"), *noise)
    high, dear = F.col("forecasted_load_mwh") > 0.5, F.col("ptf_try") > 0.5
    features = hours.withColumn("system_direction", F.when(high & dear, "ENERGY_DEFICIT").when(~high & dear, "ENERGY_SURPLUS").otherwise("IN_BALANCE"))
    grid = [{"trees": 1, "depth": 1}, {"trees": 40, "depth": 6}, {"trees": 2, "depth": 1}, {"trees": 1, "depth": 2}]
    whole, raced = forecast.search(features, grid, folds=3).collect(), forecast.race(features, grid, folds=3).collect()
    assert sum(r["fits"] for r in whole) == 12 and sum(r["fits"] for r in raced) == 7
    assert raced[0]["grid_row"] == whole[0]["grid_row"] and raced[0]["accuracy"] == pytest.approx(whole[0]["accuracy"])
    assert [r["folds"] for r in raced] == [3, 2, 1, 1]


def test_stored_models_score_as_before_and_refuse_other_features(spark, features, tmp_path):
    path = f"{tmp_path}/models"
    past, held = forecast.time_holdout(features, 7)
    fitted = forecast.fit_boosted(past, rounds=4)
    rows = lambda df: sorted(map(tuple, df.select("date", "hour", *forecast.PROBABILITIES).collect()))
    card = model_store.save(path, "direction", fitted, forecast.DIRECTION_FEATURES, past)
    loaded, told = model_store.load(spark, path, "direction", forecast.DIRECTION_FEATURES)
    assert told == card and card.version == 1 and card.rows == past.count() and rows(forecast.score_boosted(loaded, held)) == rows(forecast.score_boosted(fitted, held))
    forest = forecast.fit_direction(past, trees=3, depth=3)
    assert model_store.save(path, "direction", forest, forecast.DIRECTION_FEATURES, past).version == 2
    assert rows(forecast.score_direction(model_store.load(spark, path, "direction", forecast.DIRECTION_FEATURES)[0], held)) == rows(forecast.score_direction(forest, held))
    assert model_store.load(spark, path, "direction", forecast.DIRECTION_FEATURES, version=1)[0] == fitted
    swapped = [forecast.DIRECTION_FEATURES[1], forecast.DIRECTION_FEATURES[0], *forecast.DIRECTION_FEATURES[2:]]
    for wrong in (swapped, forecast.DIRECTION_FEATURES[:-1], [*forecast.DIRECTION_FEATURES, "more"]):
        with pytest.raises(ValueError, match="other features"):
            model_store.load(spark, path, "direction", wrong)
    with pytest.raises(LookupError):
        model_store.load(spark, path, "price", forecast.PRICE_FEATURES)
    # A save that stopped before its card was there doesn't count.
    files.put_text(spark, f"{path}/direction/version=00003/model.json", "{}")
    assert model_store.load(spark, path, "direction", forecast.DIRECTION_FEATURES)[1].version == 2 and staging.MODELS


def test_partitions_of_dealt_rows_grow_in_number_only(spark):
    rows = spark.range(3000).select((F.col("id") % 100).alias("k"))
    held = shared.dealt(rows, 3000, "k", each=100).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.collect_set("k").alias("ks")).collect()
    assert max(r["n"] for r in held) < 3000 / 4 and sum(len(r["ks"]) for r in held) == 100
    assert shared.dealt(rows, 3000, "k", each=100).rdd.getNumPartitions() == 30


@pytest.mark.parametrize("name", ["SI25_dams", "ST26_dams", "MA14_hydro_risk", "BI28_volume_movers"])
def test_reservoirs_are_dealt_once_by_their_rows(spark, sf, name):
    """One task never holds all reservoirs, whatever the session's number of shuffle partitions; small tables' broadcasts are off."""
    large = {"spark.sql.shuffle.partitions": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    held = {k: spark.conf.get(k) for k in large}
    try:
        for k, v in large.items():
            spark.conf.set(k, v)
        places = Silver(spark, sf)["dams"].groupBy(F.spark_partition_id().alias("p")).count().collect()
        plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(places) > 1 and "REPARTITION_BY_NUM" in plan
    # Rows lie by reservoir already, so nothing is moved by reservoir and day or by reservoir again.
    assert not re.search(r"Exchange hashpartitioning\([^)]*dam_?id#\d+L?, [^)]*\), ENSURE_REQUIREMENTS", plan, re.I)
    con = duckdb.connect()
    for table in ("region", "nation", "supplier", "lineitem"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    plain = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    found, twin = registry.QUERIES[name](spark, sf), con.sql(registry.ORACLE_SQL[name])
    columns = sorted(found.columns)
    wanted = twin.select(*[f'"{c}"' for c in columns]).fetchall()
    assert sorted([plain(r[c]) for c in columns] for r in found.collect()) == sorted([plain(v) for v in row] for row in wanted)


def test_outages_are_settled_once_for_all_that_read_them(spark, sf):
    """Features, their calendar and the forward features read a table of days, not the outages again; days are those of every outage by itself."""
    lake = staging.Lake(Silver(spark, sf))
    found = [marts.outage_days(lake, day) for day in (AS_OF, "2024-01-20")]
    for days, as_of in zip(found, (AS_OF, "2024-01-20"), strict=True):
        assert not {"lineitem", "orders"} & {f.rpartition("/")[2].removesuffix(".parquet") for f in days.inputFiles()}
        whole = lake["outages"].where("end_time > start_time").withColumn("last", F.least(F.to_date("end_time"), F.lit(as_of).cast("date"))).where("last >= to_date(start_time)")
        each = whole.select(F.explode(F.sequence(F.to_date("start_time"), "last")).alias("date"), "outage_capacity_mwh").groupBy("date").agg(F.sum("outage_capacity_mwh").alias("mw"))
        assert {r[0]: r[1] for r in days.collect()} == pytest.approx({r[0]: r[1] for r in each.collect()})


def test_bulk_plans_move_while_rows_are_narrow(spark, sf):
    """Lines are dealt by organisation and unit before fuels, texts and the second copy are there; nothing moves after."""
    plan = registry.QUERIES["SI9_kgup_bulk_by_org"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    moves = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]
    assert moves and all("REPARTITION_BY_NUM" in x for x in moves)
