"""Regression trees over trips: relational median tree and library tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.fraud import split_sql
from tidemark.catalog.registry import query
from tidemark.catalog.trips import DISTANCE, TRIPS, clean_sql, features_sql
from tidemark.functions.scalars import from_log_label
from tidemark.operators import histogram_tree, library_models, median_tree, tree_nodes
from tidemark.operators.split import hash_split
from tidemark.operators.trips import TRIP_FEATURES, feature_array, score_table, train_table
from tidemark.plans.regression import SPLIT, result_tables, trip_job
from tidemark.session import spread
from tidemark.sources.tables import trips

N_FEATURES = len(TRIP_FEATURES)
TRAIN = split_sql("id", SPLIT)

# Distances that are equal on paper may differ in the last bit between engines; six places keep
# the distinct values, and so the medians, the same in both.
FEATURE_LIST = ", ".join(f'cast("{c}" as double)' for c in TRIP_FEATURES)
ROWS = f"""{TRIPS},
    f as (select id, {features_sql(distance=f"round({DISTANCE}, 6)")}, ln(1 + trip_duration) as label
          from trips where {clean_sql()}),
    rows1 as (select id, label, [{FEATURE_LIST}] as features, 1 as node from f)"""


def level_sql(level: int) -> str:
    """SQL for the thresholds, gains and winners of one level, and the rows of the next."""
    n = level
    return f""",
    sums{n} as (
      select node, feature, value, count(*) as n, sum(cast(label as decimal(18, 9))) as s
      from (select node, label, unnest(features) as value, unnest(range({N_FEATURES})) as feature from rows{n})
      group by node, feature, value),
    thresholds{n} as (
      select node, feature, value as threshold
      from (select *, row_number() over (partition by node, feature order by value) as place,
                   count(*) over (partition by node, feature) as total from sums{n})
      where total >= 2 and place = total // 2 + 1),
    gains{n} as (
      select node, feature, threshold, nl, nr,
             cast(nl as double) * nr / power(cast(nl + nr as double), 2)
               * power(cast(sl as double) / nl - cast(sr as double) / nr, 2) as gain
      from (select node, feature, threshold,
                   sum(n) filter (value <= threshold) as nl, sum(n) filter (value > threshold) as nr,
                   sum(s) filter (value <= threshold) as sl, sum(s) filter (value > threshold) as sr
            from sums{n} join thresholds{n} using (node, feature) group by all)
      where nr > 0),
    winners{n} as (
      select * from (select *, row_number() over (partition by node order by gain desc, feature) as r from gains{n})
      where r = 1),
    level{n} as (
      select t.node, {n - 1} as depth, t.n_rows, t.prediction, w.feature, w.threshold
      from (select node, count(*) as n_rows, avg(label) as prediction from rows{n} group by node) t
      left join winners{n} w using (node)),
    rows{n + 1} as (
      select id, label, features,
             2 * r.node + case when features[feature + 1] <= threshold then 0 else 1 end as node
      from rows{n} r join winners{n} w on r.node = w.node)"""


def leaves_sql(level: int) -> str:
    return f""",
    level{level} as (
      select node, {level - 1} as depth, count(*) as n_rows, avg(label) as prediction,
             cast(null as int) as feature, cast(null as double) as threshold
      from rows{level} group by node)"""


NODE_COLUMNS = """cast(node as bigint) as node, cast(depth as int) as depth, cast(n_rows as bigint) as n_rows,
    round(prediction, 6) as prediction, cast(feature as int) as feature, round(threshold, 6) as threshold"""


def training_rows(spark, sf_dir) -> DataFrame:
    table = train_table(trips(spark, sf_dir)).withColumn("distance_haversine", F.round("distance_haversine", 6))
    return feature_array(table)


def _fit(spark, sf_dir, depth: int) -> tree_nodes.NodeTree:
    rows = spread(training_rows(spark, sf_dir)).persist()
    tree = median_tree.fit_median_tree(rows, TRIP_FEATURES, depth)
    rows.unpersist()
    return tree


def _root_sums(spark, sf_dir) -> DataFrame:
    return median_tree.value_sums(training_rows(spark, sf_dir).withColumn("node", F.lit(tree_nodes.ROOT).cast("long")))


@query(
    "tree_thresholds",
    f"""with {ROWS} {level_sql(1)}
    select cast(node as bigint) as node, cast(feature as int) as feature, round(threshold, 6) as threshold
    from thresholds1""",
)
def tree_thresholds(spark, sf_dir):
    splits, _ = median_tree.median_splits(_root_sums(spark, sf_dir), N_FEATURES)
    return splits.select("node", "feature", "threshold")


@query(
    "tree_split_gain",
    f"""with {ROWS} {level_sql(1)},
    long as (select label, unnest(features) as value, unnest(range({N_FEATURES})) as feature from rows1),
    sides as (
      select feature, threshold, var_pop(label) as v, count(*) as n,
             var_pop(label) filter (value <= threshold) as vl, count(*) filter (value <= threshold) as nl,
             var_pop(label) filter (value > threshold) as vr, count(*) filter (value > threshold) as nr
      from long join thresholds1 using (feature) group by feature, threshold)
    select cast(1 as bigint) as node, cast(feature as int) as feature, round(threshold, 6) as threshold,
           cast(nl as bigint) as n_left, cast(nr as bigint) as n_right,
           round(v - (vl * nl + coalesce(vr, 0) * nr) / n, 6) as gain
    from sides where nr > 0""",
)
def tree_split_gain(spark, sf_dir):
    splits, _ = median_tree.median_splits(_root_sums(spark, sf_dir), N_FEATURES)
    return median_tree.split_gains(splits)


@query(
    "median_tree_l1",
    f"""with {ROWS} {level_sql(1)} {leaves_sql(2)}
    select {NODE_COLUMNS} from (select * from level1 union all select * from level2)""",
)
def median_tree_l1(spark, sf_dir):
    return _fit(spark, sf_dir, 1).nodes


@query(
    "median_tree_l2",
    f"""with {ROWS} {level_sql(1)} {level_sql(2)} {leaves_sql(3)}
    select {NODE_COLUMNS}
    from (select * from level1 union all select * from level2 union all select * from level3)""",
)
def median_tree_l2(spark, sf_dir):
    return _fit(spark, sf_dir, 2).nodes


PREDICT_SQL = f"""with {ROWS} {level_sql(1)} {level_sql(2)} {leaves_sql(3)},
    leaf_rows as (
      select id, node, features from rows3
      union all select id, node, features from rows2 where node not in (select node from winners2))"""


@query(
    "median_tree_predict",
    PREDICT_SQL
    + """
    select r.id, round(exp(n.prediction) - 1, 6) as prediction
    from leaf_rows r join (select * from level2 union all select * from level3) n on r.node = n.node""",
)
def median_tree_predict(spark, sf_dir):
    tree = _fit(spark, sf_dir, 2)
    scored = tree_nodes.predict(training_rows(spark, sf_dir), tree)
    return scored.select("id", from_log_label(F.col("prediction")).alias("prediction"))


@query(
    "median_tree_importance",
    f"""with {ROWS} {level_sql(1)} {level_sql(2)} {leaves_sql(3)},
    splits as (select feature from level1 union all select feature from level2),
    used as (select feature from splits where feature is not null)
    select cast(i as int) as feature, name,
           round((select count(*) from used where feature = i) / (select cast(count(*) as double) from used), 6)
             as importance
    from (select unnest(range({N_FEATURES})) as i, unnest([{", ".join(f"'{c}'" for c in TRIP_FEATURES)}]) as name)""",
)
def median_tree_importance(spark, sf_dir):
    return tree_nodes.split_importances(_fit(spark, sf_dir, 2))


_NAMES = "[" + ", ".join(f"'{c}'" for c in TRIP_FEATURES) + "]"


def _decision_sql(features: str, feature: str, threshold: str) -> str:
    # Spark prints exact halves upwards; the nudge is far below the six places of the data.
    value = f"{features}[{feature} + 1]"
    return f"""{_NAMES}[{feature} + 1] || ' = ' || printf('%.4f', {value} + 1e-9)
        || case when {value} <= {threshold} then ' <= ' else ' > ' end || printf('%.4f', {threshold} + 1e-9)
        || case when {value} <= {threshold} then ', go left' else ', go right' end"""


def _leaf_sql(prediction: str) -> str:
    return f"""'Reached leaf, predict: ' || printf('%.4f', {prediction}) || ' (original scale: '
        || printf('%.2f', exp({prediction}) - 1) || ' seconds)'"""


@query(
    "decision_paths",
    PREDICT_SQL
    + f"""
    select r.id, {_decision_sql('r.features', 'a.feature', 'a.threshold')} || '; '
           || case when b.feature is null then ''
                   else {_decision_sql('r.features', 'b.feature', 'b.threshold')} || '; ' end
           || {_leaf_sql('n.prediction')} as steps
    from leaf_rows r join level1 a on true
    join level2 b on b.node = case when r.node >= 4 then r.node // 2 else r.node end
    join (select * from level2 union all select * from level3) n on n.node = r.node""",
)
def decision_paths(spark, sf_dir):
    """Decision path of every trip, the leaf on both scales included."""
    paths = tree_nodes.decision_paths(training_rows(spark, sf_dir), _fit(spark, sf_dir, 2))
    return paths.select("id", F.array_join("steps", "; ").alias("steps"))


def _walk_sql(levels: int) -> str:
    """The first three trips by id, walked down ``levels`` levels of the tree."""
    steps = f"""w0 as (
      select id, [{FEATURE_LIST}] as features, 1 as n1
      from (select id, {features_sql()} from trips) order by id limit 3)"""
    for i in range(1, levels + 1):
        child = f"2 * n{i} + case when w.features[v.feature + 1] <= v.threshold then 0 else 1 end"
        steps += f""",
    w{i} as (
      select w.*, v.feature as f{i}, v.threshold as t{i}, v.prediction as p{i},
             case when v.feature is not null then {child} end as n{i + 1}
      from w{i - 1} w left join level{i} v on v.node = w.n{i})"""
    return steps


@query(
    "sample_paths",
    f"""with {ROWS} {level_sql(1)} {level_sql(2)} {level_sql(3)} {leaves_sql(4)}, {_walk_sql(4)}
    select id, concat("""
    + ", ".join(
        f"""case when n{i} is null then '' when f{i} is null then {_leaf_sql(f'p{i}')}
             else {_decision_sql('features', f'f{i}', f't{i}')} || '; ' end"""
        for i in range(1, 5)
    )
    + ") as steps from w4",
)
def sample_paths(spark, sf_dir):
    """The first three trips by id, with their decision paths."""
    sample = feature_array(score_table(trips(spark, sf_dir))).orderBy("id").limit(3)
    paths = tree_nodes.decision_paths(sample, _fit(spark, sf_dir, 3))
    return paths.select("id", F.array_join("steps", "; ").alias("steps"))


def materialised(sql: str) -> str:
    """Every step computed once."""
    return sql.replace(" as (\n", " as materialized (\n")


def whole_walk_sql(levels: int) -> str:
    """All rows of ``held`` walked down; ``walk{n}`` has what level ``n`` predicts, or the leaf above it."""
    walk = ""
    for n in range(1, levels + 1):
        before = "select id, label, features, 1 as node, cast(null as double) as prediction from held" if n == 1 else f"select * from walk{n - 1}"
        walk += f""",
    walk{n} as (
      select id, label, w.features,
             case when v.feature is not null
                  then 2 * w.node + case when w.features[v.feature + 1] <= v.threshold then 0 else 1 end end as node,
             coalesce(v.prediction, w.prediction) as prediction
      from ({before}) w left join level{n} v on v.node = w.node)"""
    return walk


SPLIT_ROWS = f"{ROWS.replace('rows1 as', 'all_rows as')}, rows1 as (select * from all_rows where {TRAIN} = 0), held as (select * from all_rows where {TRAIN} = 1)"


def depth_errors_sql(depth: int, growth: str) -> str:
    """Errors on held-out trips by depth, of a tree grown on the others."""
    errors = [
        f"""
    select {n - 1} as depth, round(sqrt(avg(power(exp(label) - exp(prediction), 2))), 6) as rmse,
           round(1 - sum(power(exp(label) - exp(prediction), 2)) / (var_pop(exp(label) - 1) * count(*)), 6) as r2
    from walk{n}"""
        for n in range(2, depth + 2)
    ]
    return f"with {materialised(f'{SPLIT_ROWS} {growth} {whole_walk_sql(depth + 1)}')} {' union all '.join(errors)}"


def median_growth_sql(depth: int) -> str:
    return "".join(level_sql(n) for n in range(1, depth + 1)) + leaves_sql(depth + 1)


DEEP = list(range(1, 11))


@query("median_tree_deep", depth_errors_sql(max(DEEP), median_growth_sql(max(DEEP))))
def median_tree_deep(spark, sf_dir):
    """Validation error by depth of one median tree grown ten levels."""
    return _depth_errors(spark, sf_dir, DEEP)


FULL = max(library_models.TREE_DEPTHS)


@query("median_tree_full", depth_errors_sql(FULL, median_growth_sql(FULL)))
def median_tree_full(spark, sf_dir):
    """Validation error by depth of the whole default search, twenty levels."""
    return _depth_errors(spark, sf_dir, library_models.TREE_DEPTHS)


def _depth_errors(spark, sf_dir, depths: list[int]) -> DataFrame:
    train, validation = hash_split(training_rows(spark, sf_dir), "id", SPLIT)
    train = spread(train).persist()
    tree = median_tree.fit_median_tree(train, TRIP_FEATURES, max(depths))
    train.unpersist()
    return library_models.depth_metrics(tree, validation, depths)


def bins_sql(bins: int = histogram_tree.BINS) -> str:
    return f""",
    counted as (
      select feature, value, count(*) as n
      from (select unnest(features) as value, unnest(range({N_FEATURES})) as feature from rows1) group by all),
    binned as (
      select feature, value, case when size <= {bins} then place - 1 else below * {bins} // total end as bin
      from (select *, row_number() over o as place, sum(n) over o - n as below, count(*) over p as size, sum(n) over p as total
            from counted window o as (partition by feature order by value rows unbounded preceding), p as (partition by feature))),
    edges as (
      select feature, bin, max(value) as threshold from binned group by all)"""


def histogram_growth_sql(depth: int) -> str:
    """Every level: label sums per bin, running sums over bins, the best edge of each node, and the rows' children."""
    sql = bins_sql()
    for n in range(1, depth + 1):
        sql += f""",
    hist{n} as (
      select node, feature, bin, count(*) as n, sum(cast(label as decimal(18, 9))) as s
      from (select node, label, unnest(features) as value, unnest(range({N_FEATURES})) as feature from rows{n})
      join binned using (feature, value) group by all),
    gains{n} as (
      select *, cast(nl as double) * (na - nl) / power(cast(na as double), 2)
               * power(cast(sl as double) / nl - cast(sa - sl as double) / (na - nl), 2) as gain
      from (select node, feature, bin, sum(n) over o as nl, sum(s) over o as sl, sum(n) over p as na, sum(s) over p as sa
            from hist{n} window o as (partition by node, feature order by bin rows unbounded preceding),
                                p as (partition by node, feature))
      where nl < na),
    winners{n} as (
      select node, feature, threshold
      from (select *, row_number() over (partition by node order by gain desc, feature, bin) as r
            from gains{n} where gain > {histogram_tree.LEAST_GAIN!r}) join edges using (feature, bin)
      where r = 1),
    level{n} as (
      select t.node, {n - 1} as depth, t.n_rows, t.prediction, w.feature, w.threshold
      from (select node, count(*) as n_rows, avg(label) as prediction from rows{n} group by node) t
      left join winners{n} w using (node)),
    rows{n + 1} as (
      select id, label, features,
             2 * r.node + case when features[feature + 1] <= threshold then 0 else 1 end as node
      from rows{n} r join winners{n} w on r.node = w.node)"""
    return sql + leaves_sql(depth + 1)


FIT_DEPTH = 5
GROWN = f"{ROWS} {histogram_growth_sql(FIT_DEPTH)}"
ALL_LEVELS = " union all ".join(f"select * from level{n}" for n in range(1, FIT_DEPTH + 2))


def _fit_histogram(spark, sf_dir) -> tree_nodes.NodeTree:
    rows = spread(training_rows(spark, sf_dir)).persist()
    tree = histogram_tree.fit_histogram_tree(rows, TRIP_FEATURES, FIT_DEPTH)
    rows.unpersist()
    return tree


@query("tree_fit", f"with {materialised(GROWN)} select {NODE_COLUMNS} from ({ALL_LEVELS})")
def tree_fit(spark, sf_dir):
    """Nodes of a tree of depth five on quantile bins."""
    return _fit_histogram(spark, sf_dir).nodes


@query(
    "tree_predict",
    f"""with {materialised(f"{GROWN}, held as (select id, cast(null as double) as label, [{FEATURE_LIST}] as features from (select id, {features_sql(distance=f'round({DISTANCE}, 6)')} from trips)) {whole_walk_sql(FIT_DEPTH + 1)}")}
    select id, round(exp(prediction) - 1, 6) as prediction from walk{FIT_DEPTH + 1}""",
)
def tree_predict(spark, sf_dir):
    """Predictions of that tree for all trips, on the original scale; the id stays in the row throughout."""
    test = score_table(trips(spark, sf_dir)).withColumn("distance_haversine", F.round("distance_haversine", 6))
    scored = tree_nodes.predict(feature_array(test), _fit_histogram(spark, sf_dir))
    return scored.select("id", from_log_label(F.col("prediction")).alias("prediction"))


@query("tree_depth_grid", depth_errors_sql(FULL, histogram_growth_sql(FULL)))
def tree_depth_grid(spark, sf_dir):
    """Validation error by depth of the whole search: one tree of twenty levels, measured in one walk."""
    train, validation = hash_split(training_rows(spark, sf_dir), "id", SPLIT)
    train = spread(train).persist()
    tree = histogram_tree.fit_histogram_tree(train, TRIP_FEATURES, FULL)
    train.unpersist()
    return library_models.depth_metrics(tree, validation, library_models.TREE_DEPTHS)


@query(
    "tree_importance",
    f"""with {materialised(GROWN)},
    removed as (
      select p.feature, sum(cast(l.n_rows as double) * r.n_rows / (l.n_rows + r.n_rows) * power(l.prediction - r.prediction, 2)) as x
      from ({ALL_LEVELS}) p join ({ALL_LEVELS}) l on l.node = 2 * p.node join ({ALL_LEVELS}) r on r.node = 2 * p.node + 1
      group by p.feature)
    select name, round(coalesce(x, 0) / (select sum(x) from removed), 6) as importance
    from (select unnest(range({N_FEATURES})) as feature, unnest({_NAMES}) as name) left join removed using (feature)""",
)
def tree_importance(spark, sf_dir):
    """Share of the label variance that splits on each feature remove."""
    return tree_nodes.impurity_importances(_fit_histogram(spark, sf_dir)).select("name", "importance")


@query("metrics_table")
def metrics_table(spark, sf_dir):
    """Metrics, importances and tree text of a whole regression job."""
    source = trips(spark, sf_dir)
    return result_tables(trip_job(source, source, "median", depths=[1, 2, 3, 4]))
