"""Why values are missing: completely at random, explained by another column, or not at random."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill import params
from gristmill.functions.stats import chi_squared_tail, t_two_sided, welch
from gristmill.operators.profile import NUMBERS

STRATEGY = {"MCAR": "auto_impute", "MAR": "cross_file_backfill", "MNAR": "flag_for_hitl", "NONE": "skip"}


def number_tests(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """target, other, n_present, n_missing, t, df, p, gap, spread of each target and numeric other: Welch's test of the
    other's mean where the target is present against where it is missing. All pairs come from one aggregation. Pairs with
    fewer than MIN_GROUP values in a group are left out.
    """
    types = dict(df.dtypes)
    pairs = [(a, b) for a in columns for b in columns if a != b and types[b] in NUMBERS]
    if not pairs:
        return df.sparkSession.createDataFrame([], "target string, other string, n_present bigint, n_missing bigint, t double, df double, p double, gap double, spread double")
    aggs, rows = [], []
    for i, (a, b) in enumerate(pairs):
        for s, here in (("p", F.col(a).isNotNull()), ("m", F.col(a).isNull())):
            v = F.when(here, F.col(b).cast("double"))
            aggs += [F.count(v).alias(f"n{s}{i}"), F.avg(v).alias(f"a{s}{i}"), F.var_samp(v).alias(f"v{s}{i}")]
        rows.append(F.struct(F.lit(a).alias("target"), F.lit(b).alias("other"), *(F.col(f"{x}{s}{i}").alias(f"{x}{s}") for s in "pm" for x in "nav")))
    s = df.agg(*aggs).select(F.inline(F.array(*rows))).where((F.col("np") >= params.MIN_GROUP) & (F.col("nm") >= params.MIN_GROUP))
    t, d = welch(F.col("np"), F.col("ap"), F.col("vp"), F.col("nm"), F.col("am"), F.col("vm"))
    s = s.withColumn("t", t).withColumn("df", d)
    return s.select("target", "other", F.col("np").alias("n_present"), F.col("nm").alias("n_missing"), "t", "df", t_two_sided(F.col("t"), F.col("df")).alias("p"), F.abs(F.col("ap") - F.col("am")).alias("gap"), F.sqrt("vp").alias("spread"))


def category_tests(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """target, other, chi2, dof, p, high, low, identifier_like of each target and text other: Pearson's test of independence
    with Yates' correction at one degree of freedom, and whether some category is nearly always null and some nearly never.
    Tests need two categories and both null and present targets; all-null others are left out.
    """
    types = dict(df.dtypes)
    out = None
    for b in (c for c in columns if types[c] not in NUMBERS):
        targets = [a for a in columns if a != b]
        if not targets:
            continue
        # one pass over the rows for all targets; both uses below read the same shuffled groups
        groups = df.groupBy(b).agg(F.count("*").alias("n"), *(F.count_if(F.col(a).isNull()).alias(f"t{i}") for i, a in enumerate(targets)))
        known = F.col(b).isNotNull()
        tab = groups.select(known.alias("known"), "n", F.inline(F.array(*(F.struct(F.lit(a).alias("target"), F.col(f"t{i}").alias("n_null"), (F.col("n") - F.col(f"t{i}")).alias("n_present")) for i, a in enumerate(targets)))))
        sums = tab.groupBy("target").agg(
            F.sum("n_null").alias("nulls"), F.sum("n_present").alias("present"), F.count("*").alias("k"), F.count_if("known").alias("d"), F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("n_other")
        )
        full = tab.join(F.broadcast(sums), "target").withColumn("total", F.col("nulls") + F.col("present")).where("nulls > 0 and present > 0 and k >= 2 and n_other > 0")  # a row a column
        share = (F.col("n_null") + F.col("n_present")) / F.col("total")

        def term(o, e):
            off = F.abs(F.col(o) - e)
            return F.pow(off - F.when(F.col("k") == 2, F.least(F.lit(0.5), off)).otherwise(0.0), 2) / e

        rate = F.col("n_null") / (F.col("n_null") + F.col("n_present"))
        one = full.groupBy("target").agg(
            F.sum(term("n_null", share * F.col("nulls")) + term("n_present", share * F.col("present"))).alias("chi2"), (F.first("k") - 1).cast("double").alias("dof"), F.max(rate).alias("high"), F.min(rate).alias("low"),
            (F.first("d") / F.greatest(F.first("n_other"), F.lit(1)) > params.ID_RATIO).alias("identifier_like"),
        )
        one = one.select("target", F.lit(b).alias("other"), "chi2", "dof", chi_squared_tail(F.col("chi2"), F.col("dof")).alias("p"), "high", "low", "identifier_like")
        out = one if out is None else out.unionByName(one)
    return out


def classify(df: DataFrame, columns: tuple[str, ...], priors: dict[str, str] = params.PRIORS) -> DataFrame:
    """column_name, missingness_class, explained_by, strategy of each column, in this order of tests: no nulls NONE; explained
    by the first column in order MAR; a prior; independent of all others MCAR; else MNAR. Columns are metadata, so the table
    is small however many rows there are.
    """
    place = F.create_map(*(x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))))
    n = number_tests(df, columns)
    tests = n.select("target", "other", "p", ((F.col("p") < params.ALPHA) & (F.col("gap") > params.MEAN_GAP_FACTOR * F.col("spread"))).alias("explains"))
    c = category_tests(df, columns)
    if c is not None:
        explains = ~F.col("identifier_like") & (F.col("high") > params.HIGH_NULL_RATE) & (F.col("low") < params.LOW_NULL_RATE)
        tests = tests.unionByName(c.select("target", "other", "p", explains.alias("explains")))
    tests = tests.groupBy("target").agg(
        F.min_by("other", F.when(F.coalesce("explains", F.lit(False)), place[F.col("other")])).alias("explained_by"), F.coalesce(F.bool_or(F.coalesce((F.col("p") < params.ALPHA) & ~F.isnan("p"), F.lit(False))), F.lit(False)).alias("dependent"),
        F.bool_or(F.coalesce("explains", F.lit(False))).alias("explained"),
    )
    nulls = df.agg(*(F.count_if(F.col(x).isNull()).alias(x) for x in columns)).select(F.inline(F.array(*(F.struct(F.lit(x).alias("column_name"), F.col(x).alias("n_null"), F.lit(priors.get(x)).cast("string").alias("prior")) for x in columns))))
    both = nulls.join(F.broadcast(tests), F.col("column_name") == F.col("target"), "left")
    explained, dependent = F.coalesce("explained", F.lit(False)), F.coalesce("dependent", F.lit(False))
    cls = F.when(F.col("n_null") == 0, "NONE").when(explained, "MAR").when(F.col("prior").isNotNull(), F.col("prior")).when(dependent, "MNAR").otherwise("MCAR")
    out = both.select("column_name", cls.alias("missingness_class"), F.when(cls == "MAR", F.col("explained_by")).alias("explained_by"))
    return out.withColumn("strategy", F.create_map(*(F.lit(x) for kv in STRATEGY.items() for x in kv))[F.col("missingness_class")])
