"""Row filters, scaling, logistic training and classification metrics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.operators import cleaning, lbfgs, library_models, logistic, metrics, scale
from tidemark.operators.split import hash_split, split_bounds, split_number
from tidemark.plans import classification
from tidemark.session import scratch_dir, spread
from tidemark.sources import csv
from tidemark.sources.tables import FRAUD_FEATURES, fraud, labelled_vectors, read_table

FEATURES = ", ".join(FRAUD_FEATURES)
KEY = "l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber"
FRAUD = f"""
    fraud as (
      select {KEY} as row_key, {FEATURES}, case when l_returnflag = 'R' then 1 else 0 end as "Class"
      from lineitem)"""


def rounded_sql(names: list[str]) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in names)


# --- projections and filters -------------------------------------------------------------------


@query("project_except", f"with {FRAUD} select {rounded_sql(FRAUD_FEATURES)} from fraud")
def project_except(spark, sf_dir):
    return cleaning.project_except(fraud(spark, sf_dir), ["row_key", "Class"])


def _damaged(spark, sf_dir) -> DataFrame:
    """Fraud rows with nulls, NaNs and infinities at known quantities."""
    q = F.col("l_quantity").cast("int")
    tax = F.when(q % 7 == 0, F.lit(None)).when(q % 7 == 1, F.lit(float("nan"))).otherwise(F.col("l_tax"))
    price = F.when(q % 11 == 0, F.lit(float("inf"))).when(q % 11 == 1, F.lit(float("-inf")))
    return fraud(spark, sf_dir).withColumns(
        {"l_tax": tax, "l_extendedprice": price.otherwise(F.col("l_extendedprice"))}
    )


def _kept(df: DataFrame) -> DataFrame:
    return df.select("row_key", "l_quantity", "l_discount", "Class")


def _kept_sql(condition: str) -> str:
    return f"""with {FRAUD} select row_key, round(l_quantity, 6) as l_quantity, round(l_discount, 6) as l_discount,
        "Class" from fraud where {condition}"""


@query("drop_nulls", _kept_sql("cast(l_quantity as int) % 7 not in (0, 1)"))
def drop_nulls(spark, sf_dir):
    """Spark's null drop takes NaN along."""
    return _kept(cleaning.drop_nulls(_damaged(spark, sf_dir)))


@query("drop_nan", _kept_sql("cast(l_quantity as int) % 7 <> 1"))
def drop_nan(spark, sf_dir):
    return _kept(cleaning.drop_nan(_damaged(spark, sf_dir), FRAUD_FEATURES))


@query("drop_nonfinite", _kept_sql("cast(l_quantity as int) % 7 > 1 and cast(l_quantity as int) % 11 > 1"))
def drop_nonfinite(spark, sf_dir):
    return _kept(cleaning.drop_nonfinite(_damaged(spark, sf_dir), FRAUD_FEATURES))


@query(
    "distinct_rows",
    f"""with {FRAUD} select distinct {rounded_sql(FRAUD_FEATURES)}, "Class" from fraud""",
)
def distinct_rows(spark, sf_dir):
    return cleaning.distinct_rows(fraud(spark, sf_dir), [*FRAUD_FEATURES, "Class"])


@query(
    "csv_strict_scan",
    f"with {FRAUD} select {rounded_sql(FRAUD_FEATURES)}, \"Class\" as label from fraud",
)
def csv_strict_scan(spark, sf_dir):
    """Leading column ignored, label written in doubled quotes so that a quote mark survives the reader."""
    header = ["row_key", *FRAUD_FEATURES, "Class"]
    quoted = F.concat(F.lit('"'), F.col("Class").cast("string"), F.lit('"'))
    path = scratch_dir(spark, "csv-strict")
    csv.write_csv(fraud(spark, sf_dir).select(*header).withColumn("Class", quoted), path)
    rows = csv.read_labelled(spark, path, header)
    return rows.select(*[F.col("features")[i].alias(c) for i, c in enumerate(FRAUD_FEATURES)], "label")


# Columns whose odd values are rare: a whole number too large for 32 bits, a fraction, a word.
ODD_CELLS = {
    "row_key": KEY,
    "line": "cast(l_linenumber as int)",
    "wide": "case when l_orderkey % 1009 = 5 then 3000000000 + l_orderkey else cast(l_orderkey as bigint) end",
    "part": "case when l_orderkey % 1013 = 3 then l_partkey + cast(0.5 as double) else cast(l_partkey as double) end",
    "code": "case when l_orderkey % 1019 = 2 then 'n/a' else cast(l_suppkey as varchar(20)) end",
    "returned": "l_returnflag = 'R'",
    "shipped": "case when l_quantity > 5 then cast(l_shipdate as timestamp) end",
    "nothing": "cast(null as varchar(20))",
}


@query("csv_inferred_scan", f"select {', '.join(f'{sql} as {name}' for name, sql in ODD_CELLS.items())} from lineitem")
def csv_inferred_scan(spark, sf_dir):
    """A CSV read without a schema: types follow from all rows, rare odd values included."""
    path = scratch_dir(spark, "csv-inferred")
    rows = read_table(spark, sf_dir, "lineitem").selectExpr(*[f"{sql} as {name}" for name, sql in ODD_CELLS.items()])
    whole = F.when(F.col("part") == F.floor("part"), F.floor("part").cast("string")).otherwise(F.col("part").cast("string"))
    csv.write_csv(rows.withColumns({"part": whole, "shipped": F.date_format("shipped", csv.DATETIME_FORMAT)}), path)
    return csv.read_csv_inferred(spark, path)


# --- splits and scaling ------------------------------------------------------------------------



def split_sql(key: str, weights: list[float]) -> str:
    hashed = f"cast('0x' || substr(md5(coalesce({key}, '')), 1, 8) as bigint)"
    cases = " ".join(f"when {hashed} < {bound} then {i}" for i, bound in enumerate(split_bounds(weights)))
    return f"case {cases} end"


SPLIT = split_sql("row_key", classification.SPLIT)


@query("hash_split", f"with {FRAUD} select row_key, {SPLIT} as split from fraud")
def hash_split_query(spark, sf_dir):
    number = split_number(F.col("row_key"), classification.SPLIT)
    return fraud(spark, sf_dir).select("row_key", number.alias("split"))


FINE_WEIGHTS = [0.9995, 0.0003, 0.0002]
SOME_KEYS = "case when l_quantity <= 5 then null else row_key end"


@query(
    "hash_split_fine",
    f"""with {FRAUD}, keyed as (select {SOME_KEYS} as key from fraud)
    select cast({split_sql("key", FINE_WEIGHTS)} as int) as split, count(*) as n_rows, count(key) as n_keys
    from keyed group by 1""",
)
def hash_split_fine(spark, sf_dir):
    """Shares far below a thousandth, and null keys: the splits add up to all rows."""
    keyed = fraud(spark, sf_dir).select(F.expr(SOME_KEYS).alias("key"))
    parts = hash_split(keyed, "key", FINE_WEIGHTS)
    counted = [
        p.agg(F.lit(i).alias("split"), F.count("*").alias("n_rows"), F.count("key").alias("n_keys")).where("n_rows > 0")
        for i, p in enumerate(parts)
    ]
    return counted[0].union(counted[1]).union(counted[2])


@query(
    "assemble",
    f"""with {FRAUD} select row_key, {", ".join(f"round({c}, 6) as f_{i}" for i, c in enumerate(FRAUD_FEATURES))}
    from fraud""",
)
def assemble(spark, sf_dir):
    values = vector_to_array("features")
    return scale.assemble(fraud(spark, sf_dir), FRAUD_FEATURES).select(
        "row_key", *[values[i].alias(f"f_{i}") for i in range(len(FRAUD_FEATURES))]
    )


def _scaled_sql(deviation: str, floor: str) -> str:
    parts = [
        f"({c} - (select avg({c}) from train)) / (select {floor.format(f'{deviation}({c})')} from train) as {c}"
        for c in FRAUD_FEATURES
    ]
    return f"""train as (select * from fraud where {SPLIT} = 0),
    scaled as (select row_key, {SPLIT} as split, {", ".join(parts)}, "Class" as label from fraud)"""


SAMPLE_SCALED = _scaled_sql("stddev_samp", "{}")
POPULATION_SCALED = _scaled_sql("var_pop", "sqrt({} + 1e-10)")


@query("standard_scale", f"with {FRAUD}, {SAMPLE_SCALED} select row_key, {rounded_sql(FRAUD_FEATURES)} from scaled")
def standard_scale(spark, sf_dir):
    """Library scaler fitted on the training split."""
    rows = scale.assemble(fraud(spark, sf_dir), FRAUD_FEATURES, "raw_features")
    train = hash_split(rows, "row_key", classification.SPLIT)[0]
    values = vector_to_array("features")
    return scale.fit_scaler(train).transform(rows).select(
        "row_key", *[values[i].alias(c) for i, c in enumerate(FRAUD_FEATURES)]
    )


@query(
    "standard_scale_columns",
    f"with {FRAUD}, {SAMPLE_SCALED} select row_key, {rounded_sql(FRAUD_FEATURES)} from scaled",
)
def standard_scale_columns(spark, sf_dir):
    rows = fraud(spark, sf_dir)
    train = hash_split(rows, "row_key", classification.SPLIT)[0]
    return scale.scale_columns(rows, train, FRAUD_FEATURES).select("row_key", *FRAUD_FEATURES)


@query(
    "feature_moments",
    f"with {FRAUD} "
    + " union all ".join(
        f"select '{c}' as feature, round(avg({c}), 8) as mean, round(sqrt(var_pop({c}) + 1e-10), 8) as std from fraud"
        for c in FRAUD_FEATURES
    ),
    # Means of two-decimal values can end exactly on half a millionth.
    places=8,
)
def feature_moments(spark, sf_dir):
    return scale.feature_moments(fraud(spark, sf_dir), FRAUD_FEATURES)


def _arrays(spark, sf_dir) -> DataFrame:
    return fraud(spark, sf_dir).select(
        "row_key",
        F.array(*FRAUD_FEATURES).alias("features"),
        F.col("Class").cast("double").alias("label"),
        split_number(F.col("row_key"), classification.SPLIT).alias("split"),
    )


def _scaled_arrays(spark, sf_dir) -> DataFrame:
    """Population-scaled features with bias, for all splits, moments from the training split."""
    rows = _arrays(spark, sf_dir)
    means, stds = scale.array_moments(rows.filter("split = 0"), len(FRAUD_FEATURES))
    return scale.scale_array(rows, means, stds)


@query(
    "zscore_scale",
    f"""with {FRAUD}, {POPULATION_SCALED}
    select row_key, {rounded_sql(FRAUD_FEATURES)}, 1.0::double as bias from scaled""",
)
def zscore_scale(spark, sf_dir):
    names = [*FRAUD_FEATURES, "bias"]
    return _scaled_arrays(spark, sf_dir).select("row_key", *[F.col("features")[i].alias(c) for i, c in enumerate(names)])


# --- scoring and gradient descent --------------------------------------------------------------

# An arbitrary weight vector, bias last, for checking scores and gradients.
WEIGHTS = [0.4, -0.3, 0.25, -0.15, -0.7]


def dot_sql(weights: list[str]) -> str:
    terms = [f"{c} * {w}" for c, w in zip(FRAUD_FEATURES, weights)]
    return " + ".join([*terms, weights[-1]])


def sigmoid_sql(z: str) -> str:
    return f"(case when {z} > 100 then 1.0 when {z} < -100 then 0.0 else 1 / (1 + exp(-({z}))) end)"


SCORE = sigmoid_sql(f"({dot_sql([str(w) for w in WEIGHTS])})")
SCORED = f"scored as (select *, {SCORE} as score from scaled)"


@query("logistic_score", f"with {FRAUD}, {POPULATION_SCALED}, {SCORED} select row_key, round(score, 6) as score from scored")
def logistic_score(spark, sf_dir):
    return logistic.logistic_score(_scaled_arrays(spark, sf_dir), WEIGHTS).select("row_key", "score")


GRADIENT_TERMS = [*FRAUD_FEATURES, "1"]


@query(
    "gd_step",
    f"""with {FRAUD}, {POPULATION_SCALED}, {SCORED}
    select count(*) as n_rows, {", ".join(f"round(avg({c} * (score - label)), 6) as g_{i}" for i, c in enumerate(GRADIENT_TERMS))}
    from scored where split = 0""",
)
def gd_step(spark, sf_dir):
    return logistic.gradient_sums(_scaled_arrays(spark, sf_dir).filter("split = 0"), WEIGHTS)


def _descent_sql(epochs: int, rate: float, reg: float, momentum: float) -> str:
    """Gradient descent unrolled: one CTE of weights and velocities per epoch."""
    n = len(GRADIENT_TERMS)
    zeros = ", ".join(f"0.0::double as w{i}, 0.0::double as v{i}" for i in range(n))
    steps = [f"m0 as (select {zeros})"]
    for e in range(1, epochs + 1):
        score = sigmoid_sql("(" + dot_sql([f"w{i}" for i in range(n)]) + ")")
        gradients = ", ".join(f"avg({c} * ({score} - label)) as g{i}" for i, c in enumerate(GRADIENT_TERMS))
        steps.append(f"g{e} as (select {gradients} from scaled, m{e - 1} where split = 0)")
        velocity = [
            f"{momentum} * v{i} + {1 - momentum} * (g{i}" + (f" + {reg} * w{i})" if i < n - 1 else ")") for i in range(n)
        ]
        moved = ", ".join(f"w{i} - {rate} * ({v}) as w{i}, {v} as v{i}" for i, v in enumerate(velocity))
        steps.append(f"m{e} as (select {moved} from m{e - 1}, g{e})")
    return ", ".join(steps)


def _weights_frame(spark, models) -> DataFrame:
    size = len(models[0].weights)
    rows = [(i, *map(float, m.weights)) for i, m in enumerate(models)]
    return spark.createDataFrame(rows, "candidate int, " + ", ".join(f"w_{j} double" for j in range(size)))


def _weights_sql(source: str, candidate: int) -> str:
    names = ", ".join(f"round(w{i}, 6) as w_{i}" for i in range(len(GRADIENT_TERMS)))
    return f"select {candidate} as candidate, {names} from {source}"


@query(
    "gd_train",
    f"""with {FRAUD}, {POPULATION_SCALED}, {_descent_sql(3, 0.7, 0.003, 0.9)} {_weights_sql('m3', 0)}""",
)
def gd_train(spark, sf_dir):
    train = spread(_scaled_arrays(spark, sf_dir).filter("split = 0").select("features", "label"))
    params = logistic.GDParams(learning_rate=0.7, num_epochs=3, reg_param=0.003)
    models = logistic.gd_train(train, len(GRADIENT_TERMS), [params])
    return _weights_frame(spark, models)


GRID_LISTS = dict(logistic.GD_GRID_LISTS, num_epochs=[1])
GRID = logistic.param_grid(GRID_LISTS)


@query(
    "param_grid",
    f"""with {FRAUD}, {POPULATION_SCALED}, {_descent_sql(1, 1.0, 0.0, 0.0)},
    grid as (
      select row_number() over () - 1 as candidate, learning_rate, reg_param
      from (select unnest([0.1, 0.3, 0.5, 0.7, 1.0]) as learning_rate) a,
           (select unnest([0.003, 0.001, 0.0007]) as reg_param) b),
    moved as (select learning_rate, reg_param,
                     {", ".join(f"w{i} * learning_rate * (1 - 0.9) as w{i}" for i in range(len(GRADIENT_TERMS)))}
              from grid, m1),
    probs as (
      select learning_rate, reg_param, {" + ".join(f"w{i} * w{i}" for i in range(len(FRAUD_FEATURES)))} as squares,
             label, {sigmoid_sql("(" + dot_sql([f"w{i}" for i in range(len(GRADIENT_TERMS))]) + ")")} as p
      from scaled, moved where split = 0)
    select cast(learning_rate as double) as learning_rate, cast(reg_param as double) as reg_param,
           round(avg(case when label = 1 then -581.0 * ln(p + 1e-10) else -ln(1 - p + 1e-10) end)
                 + max(reg_param * squares), 6) as loss
    from probs group by learning_rate, reg_param""",
)
def param_grid(spark, sf_dir):
    """Loss of every grid combination after one epoch, all from the same two passes."""
    train = spread(_scaled_arrays(spark, sf_dir).filter("split = 0").select("features", "label"))
    models = logistic.gd_train(train, len(GRADIENT_TERMS), GRID)
    rows = [(m.params.learning_rate, m.params.reg_param, m.losses[0]) for m in models]
    return spark.createDataFrame(rows, "learning_rate double, reg_param double, loss double")


def _gd_grid_sql() -> str:
    """The whole descent of all candidates as one recursion, early stops included, and their validation metrics."""
    p = logistic.GDParams()
    rates, regs = logistic.GD_GRID_LISTS["learning_rate"], logistic.GD_GRID_LISTS["reg_param"]
    n = len(GRADIENT_TERMS)
    w, v = [f"w{i}" for i in range(n)], [f"v{i}" for i in range(n)]
    score = sigmoid_sql(f"({dot_sql(w)})")
    gradients = ", ".join(f"avg({term} * ({score} - label)) as g{i}" for i, term in enumerate(GRADIENT_TERMS))
    loss = f"avg(case when label = 1 then -581.0 * ln({score} + 1e-10) else -ln(1 - {score} + 1e-10) end)"
    squares = " + ".join(f"any_value({x}) * any_value({x})" for x in w[:-1])
    velocity = ", ".join(
        f"{p.momentum} * v{i} + {1 - p.momentum} * (g{i}{f' + reg * w{i}' if i < n - 1 else ''}) as u{i}" for i in range(n)
    )
    checked = f"t >= 1 and ((t - 1) % 5 = 0 or t = {p.num_epochs})"
    return f"""with recursive {FRAUD}, {POPULATION_SCALED},
    taught as materialized (select * from scaled where split = 0),
    runs(candidate, rate, reg, t, lowest, {", ".join(w + v)}) as (
      select i * {len(regs)} + j, rate, reg, 0, 'infinity'::double, {", ".join("0.0::double" for _ in w + v)}
      from (select unnest({rates})::double as rate, unnest(range({len(rates)})) as i),
           (select unnest({regs})::double as reg, unnest(range({len(regs)})) as j)
      union all
      select candidate, rate, reg, t + 1, case when {checked} then least(lowest, loss) else lowest end,
             {", ".join(f"w{i} - rate * u{i}" for i in range(n))}, {", ".join(f"u{i}" for i in range(n))}
      from (select *, {velocity}
            from (select candidate, rate, reg, t, any_value(lowest) as lowest, {", ".join(f"any_value({x}) as {x}" for x in w + v)},
                         {gradients}, {loss} + reg * ({squares}) as loss
                  from runs, taught where t < {p.num_epochs} group by candidate, rate, reg, t)
            where not ({checked} and t - 1 > {p.early_stop_patience} and loss > lowest * {p.early_stop_factor}))),
    last as (select candidate, {", ".join(f"arg_max({x}, t) as {x}" for x in w)} from runs group by candidate),
    scored as (select candidate, label, {score} as score from scaled, last where split = 1),
    t as (select unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::double[]) as threshold, unnest(range(9)) as threshold_index),
    c as (select candidate, threshold_index, threshold,
                 count(*) filter (score > threshold and label = 1) as tp, count(*) filter (score > threshold and label = 0) as fp,
                 count(*) filter (score <= threshold and label = 0) as tn, count(*) filter (score <= threshold and label = 1) as fn
          from scored, t group by all),
    r as (select *, tp / (tp + fp + 1e-10) as p, tp / (tp + fn + 1e-10) as q from c)
    select cast(candidate as int) as candidate, cast(threshold_index as int) as threshold_index, threshold, tp, fp, tn, fn,
           round((tp + tn) / (tp + tn + fp + fn + 1e-10), 6) as accuracy, round(p, 6) as "precision",
           round(q, 6) as recall, round(2 * p * q / (p + q + 1e-10), 6) as f1_score from r"""


@query("gd_grid", _gd_grid_sql())
def gd_grid(spark, sf_dir):
    """Validation metrics of every (candidate, threshold) of the full grid."""
    rows = _scaled_arrays(spark, sf_dir)
    train = spread(rows.filter("split = 0").select("features", "label"))
    _, table = logistic.gd_search(train, rows.filter("split = 1"), len(GRADIENT_TERMS))
    return table


def _sgd_sql(iterations: int, step: float, reg: float) -> str:
    n = len(FRAUD_FEATURES)
    steps = ["s0 as (select " + ", ".join(f"0.0::double as w{i}" for i in range(n)) + ")"]
    for t in range(1, iterations + 1):
        z = " + ".join(f"{c} * w{i}" for i, c in enumerate(FRAUD_FEATURES))
        score = sigmoid_sql(f"({z})")
        gradients = ", ".join(f"avg({c} * ({score} - label)) as g{i}" for i, c in enumerate(FRAUD_FEATURES))
        steps.append(f"d{t} as (select {gradients} from scaled, s{t - 1} where split = 0)")
        rate = f"({step} / sqrt({t}))"
        moved = ", ".join(f"w{i} * (1 - {rate} * {reg}) - {rate} * g{i} as w{i}" for i in range(n))
        steps.append(f"s{t} as (select {moved} from s{t - 1}, d{t})")
    return ", ".join(steps)


def _without_bias(spark, sf_dir) -> DataFrame:
    """Sample-scaled features without bias, as the library route takes them."""
    rows = _arrays(spark, sf_dir)
    means, stds = scale.array_moments(rows.filter("split = 0"), len(FRAUD_FEATURES), sample=True)
    return scale.scale_array(rows, means, stds).withColumn("features", F.slice("features", 1, len(FRAUD_FEATURES)))


@query(
    "logreg_sgd",
    f"""with {FRAUD}, {SAMPLE_SCALED}, {_sgd_sql(3, 15.0, 0.01)}
    select 15.0::double as step, 3 as iterations, {", ".join(f"round(w{i}, 6) as w_{i}" for i in range(len(FRAUD_FEATURES)))}
    from s3""",
)
def logreg_sgd(spark, sf_dir):
    train = spread(_without_bias(spark, sf_dir).filter("split = 0").select("features", "label"))
    models = logistic.sgd_train(train, len(FRAUD_FEATURES), [15.0], [3])
    rows = [(float(m.step), m.iterations, *m.weights) for m in models]
    schema = "step double, iterations int, " + ", ".join(f"w_{i} double" for i in range(len(FRAUD_FEATURES)))
    return spark.createDataFrame(rows, schema)


def _sgd_grid_sql(steps: list[int], iterations: list[int], reg: float = 0.01, tolerance: float = 0.001) -> str:
    """All runs of the search as one recursion: a step's weights move until they hardly do, and stay then."""
    n = len(FRAUD_FEATURES)
    weights = [f"w{i}" for i in range(n)]
    z = " + ".join(f"{c} * {w}" for c, w in zip(FRAUD_FEATURES, weights))
    gradients = ", ".join(f"avg({c} * ({sigmoid_sql(f'({z})')} - label)) as g{i}" for i, c in enumerate(FRAUD_FEATURES))
    moved = ", ".join(f"{w} * (1 - step / sqrt(t) * {reg}) - step / sqrt(t) * g{i} as u{i}" for i, w in enumerate(weights))
    gone = " + ".join(f"power({w} - u{i}, 2)" for i, w in enumerate(weights))
    size = " + ".join(f"u{i} * u{i}" for i in range(n))
    new = ", ".join(f"u{i}" for i in range(n))
    return f"""with recursive {FRAUD}, {SAMPLE_SCALED},
    taught as materialized (select * from scaled where split = 0),
    runs(step, t, done, {", ".join(weights)}) as (
      select unnest({steps})::double, 0, false, {", ".join("0.0::double" for _ in weights)}
      union all
      select step, t, t > 1 and sqrt({gone}) < {tolerance} * greatest(sqrt({size}), 1.0), {new}
      from (select step, t, {", ".join(weights)}, {moved}
            from (select step, t + 1 as t, {", ".join(f"any_value({w}) as {w}" for w in weights)}, {gradients}
                  from runs, taught where not done and t < {max(iterations)} group by step, t))),
    picked as (
      select i * {len(iterations)} + j as candidate, {", ".join(f"arg_max({w}, t) as {w}" for w in weights)}
      from runs join (select unnest({steps})::double as step, unnest(range({len(steps)})) as i) using (step),
           (select unnest({iterations}) as most, unnest(range({len(iterations)})) as j)
      where t <= most group by i, j),
    scored as (select candidate, label, {sigmoid_sql(f'({z})')} as score from scaled, picked where split = 1),
    c as (select candidate, count(*) filter (score > 0.5 and label = 1) as tp, count(*) filter (score > 0.5 and label = 0) as fp,
                 count(*) filter (score <= 0.5 and label = 0) as tn, count(*) filter (score <= 0.5 and label = 1) as fn
          from scored group by candidate),
    r as (select *, tp / (tp + fp + 1e-10) as p, tp / (tp + fn + 1e-10) as q from c)
    select cast(candidate as int) as candidate, 0 as threshold_index, 0.5::double as threshold, tp, fp, tn, fn,
           round((tp + tn) / (tp + tn + fp + fn + 1e-10), 6) as accuracy, round(p, 6) as "precision",
           round(q, 6) as recall, round(2 * p * q / (p + q + 1e-10), 6) as f1_score from r"""


@query("logreg_sgd_grid", _sgd_grid_sql(logistic.SGD_STEPS, logistic.SGD_ITERATIONS))
def logreg_sgd_grid(spark, sf_dir):
    """Validation metrics of the step x iterations search."""
    rows = _without_bias(spark, sf_dir)
    train = spread(rows.filter("split = 0").select("features", "label"))
    models = logistic.sgd_train(train, len(FRAUD_FEATURES), logistic.SGD_STEPS, logistic.SGD_ITERATIONS)
    scored = logistic.score_candidates(rows.filter("split = 1"), [m.weights for m in models])
    return metrics.threshold_metrics(scored, [0.5], by=["candidate"])


@query("logreg_fit")
def logreg_fit(spark, sf_dir):
    """Library fit on embedding vectors, as a metrics table."""
    rows = labelled_vectors(spark, sf_dir)
    names = [f"e{i}" for i in range(64)]
    flat = rows.select("id", *[F.col("features")[i].alias(n) for i, n in enumerate(names)], F.col("label").alias("Class"))
    return classification.library_job(flat, "id", names, "Class")


# The best weights by another way: Newton's method, whose three equations are solved by determinants.
NEWTON_SQL = """
with recursive x as (
  select embedding[1]::double as a, embedding[2]::double as b, case when label = 0 then 1.0 else 0.0 end as y from embeddings
  where embedding[1] is not null and embedding[2] is not null and label is not null),
fit as (
  select 0 as k, 0.0::double as wa, 0.0::double as wb, 0.0::double as wc
  union all
  select k + 1,
         wa - (ga * (hbb * n - hb * hb) - hab * (gb * n - hb * gc) + ha * (gb * hb - hbb * gc)) / det,
         wb - (haa * (gb * n - hb * gc) - ga * (hab * n - hb * ha) + ha * (hab * gc - gb * ha)) / det,
         wc - (haa * (hbb * gc - gb * hb) - hab * (hab * gc - gb * ha) + ga * (hab * hb - hbb * ha)) / det
  from (
    select *, haa * (hbb * n - hb * hb) - hab * (hab * n - hb * ha) + ha * (hab * hb - hbb * ha) as det
    from (
      select k, wa, wb, wc, sum(a * (p - y)) as ga, sum(b * (p - y)) as gb, sum(p - y) as gc,
             sum(a * a * p * (1 - p)) as haa, sum(a * b * p * (1 - p)) as hab, sum(b * b * p * (1 - p)) as hbb,
             sum(a * p * (1 - p)) as ha, sum(b * p * (1 - p)) as hb, sum(p * (1 - p)) as n
      from (select k, wa, wb, wc, a, b, y, 1 / (1 + exp(-(wa * a + wb * b + wc))) as p from fit, x where k < 15)
      group by k, wa, wb, wc)))
select 'e0' as feature, round(wa, 5) as weight from fit where k = 15
union all select 'e1', round(wb, 5) from fit where k = 15
union all select 'intercept', round(wc, 5) from fit where k = 15
"""


@query("logreg_lbfgs", NEWTON_SQL)
def logreg_lbfgs(spark, sf_dir):
    """Best weights of two vector components and the intercept."""
    rows = labelled_vectors(spark, sf_dir).select(F.slice("features", 1, 2).alias("features"), "label")
    whole = rows.filter("features[0] is not null and features[1] is not null and label is not null")
    train = spread(whole).persist()
    model = lbfgs.lbfgs_train(train, 2)
    train.unpersist()
    named = list(zip(("e0", "e1", "intercept"), model.weights))
    return spark.createDataFrame(named, "feature string, weight double").withColumn("weight", F.round("weight", 5))


@query("fraud_gd_job")
def fraud_gd_job(spark, sf_dir):
    """Whole gradient-descent job over the full grid."""
    return classification.gd_job(fraud(spark, sf_dir), FRAUD_FEATURES, "Class")


# --- metrics -----------------------------------------------------------------------------------

# A score with many ties and a prediction from it.
PREDICTED = f"""{FRAUD},
    predicted as (select "Class" as label, l_quantity / 51.0 as score,
                         case when l_quantity > 25 then 1 else 0 end as prediction from fraud)"""


def _predicted(spark, sf_dir) -> DataFrame:
    return fraud(spark, sf_dir).select(
        F.col("Class").alias("label"),
        (F.col("l_quantity") / 51.0).alias("score"),
        F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("prediction"),
    )


COUNTS = """count(*) filter (prediction = 1 and label = 1) as tp, count(*) filter (prediction = 1 and label = 0) as fp,
    count(*) filter (prediction = 0 and label = 0) as tn, count(*) filter (prediction = 0 and label = 1) as fn"""


@query("confusion", f"with {PREDICTED} select {COUNTS} from predicted")
def confusion(spark, sf_dir):
    return metrics.confusion(_predicted(spark, sf_dir))


@query(
    "binary_metrics",
    f"""with {PREDICTED}, c as (select {COUNTS} from predicted)
    select round((tp + tn) / (tp + fp + tn + fn), 6) as accuracy, round(tp / (tp + fp), 6) as "precision",
           round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1_score
    from c""",
)
def binary_metrics(spark, sf_dir):
    return metrics.binary_metrics(_predicted(spark, sf_dir))


THRESHOLDS = f"""with {PREDICTED},
    t as (select unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::double[]) as threshold,
                 unnest(range(9)) as threshold_index),
    c as (select threshold_index, threshold,
                 count(*) filter (score > threshold and label = 1) as tp,
                 count(*) filter (score > threshold and label = 0) as fp,
                 count(*) filter (score <= threshold and label = 0) as tn,
                 count(*) filter (score <= threshold and label = 1) as fn
          from predicted, t group by all),
    r as (select *, tp / (tp + fp + 1e-10) as p, tp / (tp + fn + 1e-10) as q from c),
    m as (select cast(threshold_index as int) as threshold_index, threshold, tp, fp, tn, fn,
                 round((tp + tn) / (tp + tn + fp + fn + 1e-10), 6) as accuracy, round(p, 6) as "precision",
                 round(q, 6) as recall, round(2 * p * q / (p + q + 1e-10), 6) as f1_score from r)"""


@query("threshold_metrics", f"{THRESHOLDS} select * from m")
def threshold_metrics(spark, sf_dir):
    return metrics.threshold_metrics(_predicted(spark, sf_dir))


@query("best_threshold", f"{THRESHOLDS} select * from m order by f1_score desc, threshold_index limit 1")
def best_threshold(spark, sf_dir):
    table = metrics.threshold_metrics(_predicted(spark, sf_dir))
    return metrics.best_candidate(table, "f1_score", "threshold_index")


@query(
    "cross_entropy",
    f"""with {PREDICTED}, p as (select label, greatest(least(prediction, 1 - 1e-15), 1e-15) as p from predicted)
    select round(avg(-label * ln(p) - (1 - label) * ln(1 - p)), 6) as cross_entropy from p""",
)
def cross_entropy(spark, sf_dir):
    return metrics.hard_cross_entropy(_predicted(spark, sf_dir))


@query(
    "log_loss",
    f"""with {FRAUD}, {POPULATION_SCALED}, {SCORED}
    select round(avg(case when label = 1 then -581.0 * ln(score + 1e-10) else -ln(1 - score + 1e-10) end)
                 + 0.003 * ({" + ".join(f"{w} * {w}" for w in WEIGHTS[:-1])}), 6) as loss
    from scored where split = 0""",
)
def log_loss(spark, sf_dir):
    scored = logistic.logistic_score(_scaled_arrays(spark, sf_dir).filter("split = 0"), WEIGHTS)
    return metrics.log_loss(scored, class_weights={0: 1.0, 1: 581.0}, weights=WEIGHTS, reg_param=0.003)


@query(
    "weighted_metrics",
    f"""with {PREDICTED}, c as (select {COUNTS} from predicted)
    select round((tp + tn) / (tp + fp + tn + fn), 6) as accuracy,
           round(((tp + fn) * (tp / (tp + fp)) + (tn + fp) * (tn / (tn + fn))) / (tp + fp + tn + fn), 6)
             as weighted_precision,
           round((tp + tn) / (tp + fp + tn + fn), 6) as weighted_recall
    from c""",
)
def weighted_metrics(spark, sf_dir):
    return metrics.weighted_metrics(_predicted(spark, sf_dir))


@query(
    "auc_rank",
    f"""with {PREDICTED},
    g as (select score, count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg from predicted group by score),
    r as (select *, sum(neg) over (order by score) - neg as below from g)
    select round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) as auc from r""",
)
def auc_rank(spark, sf_dir):
    return metrics.area_under_roc(_predicted(spark, sf_dir))


AUC_SCALED = f"""with {FRAUD}, {POPULATION_SCALED}, {SCORED},
    g as (select score, count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg from scored group by score),
    r as (select *, sum(neg) over (order by score) - neg as below from g)"""


@query("auc_continuous", f"{AUC_SCALED} select round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) as auc from r")
def auc_continuous(spark, sf_dir):
    """Nearly all scores distinct."""
    return metrics.area_under_roc(logistic.logistic_score(_scaled_arrays(spark, sf_dir), WEIGHTS))
