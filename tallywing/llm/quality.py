"""Quality rules: base counts of a text and robust multivariate outliers per language and source.

Every text becomes a vector of transformed statistics. For each language and source the minimum
covariance determinant (MCD) estimate of centre and scatter is found by concentration steps: take the
``CORE`` share of the rows with the smallest Mahalanobis distances, estimate again, repeat while the
determinant of a group falls. A row is rejected when its distance from the reweighted estimate passes the cut-off.

One step reads the vectors once: sums and cross products per (group, distance bucket) merge on the
map side, and the buckets up to the one that holds the ``CORE`` share are added up. Vectors are
integers (thousandths), so all sums are exact and do not depend on how rows are spread or repeated.

Defined results: null text counts as empty; a text without words has no vector, gets zero counts, and
fails the base rules; null language or source is a group of its own; groups with fewer than
``MIN_GROUP`` vectors are estimated with their whole language, languages below it with all rows;
repeated rows count as often as they occur and get the same verdict; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallywing.llm.common import bounded, free, row_key, small, words
from tallywing.session import stage

#: Share of a group that the determinant is taken over.
CORE = 0.75
#: Concentration steps at most. They end as soon as no group's determinant falls any more.
STEPS = 12
#: Vectors that a group needs for an estimate of its own.
MIN_GROUP = 100
#: Share of a chi-square law with six degrees of freedom, its quantile, and the factor that makes
#: scatter of the inner 75 % (97.5 %) consistent with a normal law.
CORE_FACTOR, REWEIGHT_CUT, REWEIGHT_FACTOR = 1.36, 14.45, 1.09
#: Squared distance beyond which a row is rejected: 99.9 % quantile of that law.
FAR = 22.46
#: Least standard deviation of each statistic, in thousandths: a group whose core never shows a
#: symbol must not reject the first one.
FLOORS = (400, 150, 60, 150, 150, 80)
#: Groups up to which their estimates (about 250 bytes each) are broadcast.
GROUPS = 200_000
#: Rejected rows (8 bytes of key each) up to which their list is broadcast.
REJECTED = 4_000_000
DIM = len(FLOORS)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the base counts, ``base_failed`` and the vector ``f0`` to ``f5`` to every row, without a shuffle.

    The statistics: logarithm of the word count and of the mean word length, and square roots of the
    shares of symbols, repeated lines, words in repeated windows, and characters that are not lower case.
    """
    clash = [c for c in docs.columns if c.lower() in {*COUNTS, "base_failed", *(f"f{i}" for i in range(DIM))}]
    docs = docs.drop(*clash) if clash else docs
    t, w, h, g, s, p, lines, other = free(docs, "t_", "w_", "h_", "g_", "s_", "p_", "lines_", "other_")
    df = docs.withColumn(t, F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn(w, F.expr(words(t)))
    df = df.withColumns({
        h: F.expr(f"transform({w}, x -> xxhash64(x))"),
        "n_words": F.expr(f"cast(size({w}) as bigint)"),
        "word_chars": F.expr(f"cast(length(array_join({w}, '')) as bigint)"),
        "n_symbols": F.expr(f"cast(size(split({t}, '[#*$%&|<>]', -1)) - 1 as bigint)"),
        lines: F.expr(f"filter(split({t}, '\\n', -1), l -> l rlike '[^ \\\\t-\\\\r]')"),
        other: F.expr(f"length(regexp_replace({t}, '[\\\\p{{Ll}} \\\\t-\\\\r]+', ''))"),
    })
    window = ", ".join(f"{h}[i + {k}]" for k in range(5))
    df = df.withColumns({
        g: F.expr(f"if(size({h}) < 5, array(), transform(sequence(0, size({h}) - 5), i -> xxhash64({window})))"),
        "n_dup_lines": F.expr(f"cast(size({lines}) - size(array_distinct({lines})) as bigint)"),
    })
    # Only texts with a repeated window sort their windows.
    df = df.withColumn(s, F.expr(
        f"if(size(array_distinct({g})) = size({g}), null, sort_array(transform({g}, (x, i) -> struct(x as h, i as p))))"))
    df = df.withColumn(p, F.expr(
        f"sort_array(transform(filter(transform({s}, (x, j) -> if(get({s}, j - 1).h <=> x.h or get({s}, j + 1).h <=> x.h, x.p, -1)),"
        " q -> q >= 0), q -> q))"))
    df = df.withColumn("n_repeat_words", F.expr(
        f"coalesce(aggregate({p}, struct(0L as n, 0 as stop),"
        " (a, q) -> struct(a.n + (q + 5 - greatest(q, a.stop)) as n, q + 5 as stop), a -> a.n), 0L)"))
    share = {2: f"n_symbols / word_chars", 3: f"n_dup_lines / size({lines})", 4: "n_repeat_words / n_words", 5: f"{other} / word_chars"}
    vector = {"f0": "ln(n_words)", "f1": "ln(word_chars / n_words)"} | {f"f{i}": f"sqrt({x})" for i, x in share.items()}
    df = df.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    df = df.withColumns({k: F.expr(f"if(n_words = 0, null, cast(round(1000 * {x}) as bigint))") for k, x in vector.items()})
    return df.drop(t, w, h, g, s, p, lines, other)


# The steps below are plain SQL text over ``vec(grp, f0..f5)`` and small per-group tables.


def start_sql() -> str:
    """Medians and quartile spreads of each statistic per group, from counts of its values in steps of 20."""
    values = ", ".join(f"struct({i} as d, cast(floor(f{i} / 20.0) as bigint) as v)" for i in range(DIM))
    picks = ", ".join(
        f"max(case when d = {i} then q2 end) * 20.0 + 10 as m{i}, max(case when d = {i} then q3 - q1 end) * 20.0 / 1.349 as r{i}"
        for i in range(DIM))
    return f"""
with x as (select grp, e.d, e.v, count(*) as n from (select grp, explode(array({values})) as e from vec) group by grp, e.d, e.v),
     y as (select grp, d, v, n, sum(n) over (partition by grp, d order by v) as upto, sum(n) over (partition by grp, d) as total from x),
     q as (select grp, d, min(case when 4 * upto >= total then v end) as q1, min(case when 2 * upto >= total then v end) as q2,
                  min(case when 4 * upto >= 3 * total then v end) as q3 from y group by grp, d)
select grp, {picks} from q group by grp"""


def diagonal_sql(start: str) -> str:
    cells = ", ".join(f"{f'r{i} * r{i} + {FLOORS[i] ** 2}e0' if i == j else '0e0'} as c{i}{j}" for i, j in _PAIRS)
    return f"select grp, {', '.join(f'm{i}' for i in range(DIM))}, {cells} from ({start}) start_"


def factor_sql(moments: str) -> str:
    """Lower triangular factor of the scatter, column by column."""
    sql = moments
    for j in range(DIM):
        done = " - ".join([f"c{j}{j}"] + [f"l{j}{k} * l{j}{k}" for k in range(j)])
        sql = f"select *, sqrt({done}) as l{j}{j} from ({sql}) a{j}_"
        if j + 1 < DIM:
            below = ", ".join(
                f"({' - '.join([f'c{i}{j}'] + [f'l{i}{k} * l{j}{k}' for k in range(j)])}) / l{j}{j} as l{i}{j}" for i in range(j + 1, DIM))
            sql = f"select *, {below} from ({sql}) b{j}_"
    keep = ", ".join([f"m{i}" for i in range(DIM)] + [f"l{i}{j}" for i, j in _PAIRS])
    return f"select grp, {keep} from ({sql}) c_"


def distance_sql(vectors: str, estimate: str, keep: str) -> str:
    """Squared Mahalanobis distance ``d2`` of every vector, by forward substitution."""
    sql = f"select {keep}, f0, f1, f2, f3, f4, f5, e.* from {vectors} v join {estimate} e on v.grp = e.grp2"
    for i in range(DIM):
        less = "".join(f" - l{i}{k} * z{k}" for k in range(i))
        sql = f"select *, (f{i} - m{i}{less}) / l{i}{i} as z{i} from ({sql}) z{i}_"
    return f"select *, {' + '.join(f'z{i} * z{i}' for i in range(DIM))} as d2 from ({sql}) d_"


def moments_sql(distances: str, condition: str | None, factor: float) -> str:
    """Centre and scatter of the inner rows; without a condition, of the ``CORE`` share with the least distances.

    The share is met by whole buckets of 1/64 octave, so rows of equal distance stay together.
    """
    sums = ", ".join([f"sum(f{i}) as s{i}" for i in range(DIM)] + [f"sum(f{i} * f{j}) as p{i}{j}" for i, j in _PAIRS])
    again = ", ".join([f"sum(s{i}) as s{i}" for i in range(DIM)] + [f"sum(p{i}{j}) as p{i}{j}" for i, j in _PAIRS])
    names = ", ".join([f"s{i}" for i in range(DIM)] + [f"p{i}{j}" for i, j in _PAIRS])
    mean = ", ".join(f"cast(s{i} as double) / n as m{i}" for i in range(DIM))
    cells = ", ".join(
        f"{factor}e0 * (cast(p{i}{j} as double) / n - (cast(s{i} as double) / n) * (cast(s{j} as double) / n))"
        f"{f' + {FLOORS[i] ** 2}e0' if i == j else ''} as c{i}{j}" for i, j in _PAIRS)
    bucket = "cast(floor(64 * log2(1 + d2)) as bigint)" if condition is None else "cast(0 * f0 as bigint)"
    within = "" if condition is None else f"where {condition}"
    return f"""
select grp, {mean}, {cells} from (
  select grp, sum(n) as n, {again} from (
    select grp, n, {names}, sum(n) over (partition by grp order by b) as upto, sum(n) over (partition by grp) as total from (
      select grp, {bucket} as b, count(*) as n, {sums} from ({distances}) m1_ {within} group by grp, {bucket}) m2_) m3_
  where upto - n < {CORE}e0 * total group by grp) m4_"""


def better_sql(old: str, new: str) -> str:
    """Of two estimates of a group the one with the smaller determinant, the old one among equals."""
    determinant = " * ".join(f"l{i}{i}" for i in range(DIM))
    keep = ", ".join(["grp", *(f"m{i}" for i in range(DIM)), *(f"l{i}{j}" for i, j in _PAIRS)])
    return f"""
select {keep} from (select *, row_number() over (partition by grp order by {determinant}, age) as place
  from (select {keep}, 0 as age from {old} union all select {keep}, 1 as age from ({new}) n1_) n2_) n3_ where place = 1"""


def grouped_sql(vec: str) -> str:
    """The group each vector is estimated with: language and source, the language, or all."""
    return f"""
select lang_key, source_key, case when n >= {MIN_GROUP} then concat('s', lang_key, ' ', source_key)
            when m >= {MIN_GROUP} then concat('l', lang_key) else 'a' end as grp
from (select lang_key, source_key, n, sum(n) over (partition by lang_key) as m
      from (select lang_key, source_key, count(*) as n from {vec} group by lang_key, source_key) g1_) g2_"""


def with_keys(df: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Keys in which null differs from every value."""
    return df.withColumns({
        k: F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for k, c in (("lang_key", lang_col), ("source_key", source_col))})


def estimates(vec: DataFrame) -> DataFrame:
    """Reweighted MCD estimate per (lang_key, source_key) from rows (lang_key, source_key, f0..f5)."""
    spark = vec.sparkSession
    groups = small(spark.sql(grouped_sql("{vec}"), vec=vec), "groups")
    vec = vec.join(bounded(groups, GROUPS), ["lang_key", "source_key"]).select("grp", *(f"f{i}" for i in range(DIM)))

    def run(sql: str, name: str, **tables: DataFrame) -> DataFrame:
        return small(spark.sql(sql, **tables), name)

    estimate = run(factor_sql(diagonal_sql(start_sql().replace("from vec", "from {vec}"))), "start", vec=vec)
    inner = distance_sql("{vec}", "{estimate}", "v.grp")

    def improved(sql: str) -> DataFrame:
        return run(sql, "estimate", vec=vec, old=estimate, estimate=bounded(estimate.withColumnRenamed("grp", "grp2"), GROUPS))

    concentrated = factor_sql(moments_sql(inner, None, CORE_FACTOR))
    estimate = improved(concentrated)
    for _ in range(STEPS - 1):
        before, estimate = estimate, improved(better_sql("{old}", concentrated))
        if estimate.exceptAll(before).isEmpty():
            break
    estimate = improved(factor_sql(moments_sql(inner, f"d2 <= {REWEIGHT_CUT}e0", REWEIGHT_FACTOR)))
    return small(groups.join(estimate, "grp"), "estimates")


def judge(counted: DataFrame, estimate: DataFrame) -> DataFrame:
    """Add ``kept`` and the squared distance ``outlyingness`` (null without words) to counted rows."""
    spark = counted.sparkSession
    table = estimate.withColumnsRenamed({"lang_key": "lk_", "source_key": "sk_"}).drop("grp")
    df = counted.join(bounded(table, GROUPS), (F.col("lang_key") == F.col("lk_")) & (F.col("source_key") == F.col("sk_")), "left")
    for i in range(DIM):
        z = F.expr(f"(f{i} - m{i}{''.join(f' - l{i}{k} * z{k}_' for k in range(i))}) / l{i}{i}")
        df = df.withColumn(f"z{i}_", z)
    df = df.withColumn("outlyingness", F.expr(" + ".join(f"z{i}_ * z{i}_" for i in range(DIM))))
    df = df.withColumn("kept", F.expr(f"not base_failed and coalesce(outlyingness <= {FAR}, false)"))
    return df.drop("lk_", "sk_", *table.columns, *(f"z{i}_" for i in range(DIM)))


def _verdicts(docs: DataFrame, keep: list[Column], text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``keep``, counts and verdict per row. Counts are written once, without the texts; all later steps read those."""
    rows = docs.select(*keep, F.col(text_col).alias("text_"), F.col(lang_col).alias("lang_"), F.col(source_col).alias("source_"))
    counted = with_keys(with_counts(rows, "text_"), "lang_", "source_").drop("text_", "lang_", "source_")
    counted = stage(counted, "counted")
    vectors = counted.filter("n_words > 0").select("lang_key", "source_key", *(f"f{i}" for i in range(DIM)))
    return judge(counted, estimates(vectors))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source") -> DataFrame:
    """One row per document: id, base counts, base verdict, ``kept`` and ``outlyingness``."""
    judged = _verdicts(docs, [F.col(id_col).alias("id_")], text_col, lang_col, source_col)
    return judged.select(F.col("id_").alias(id_col), *COUNTS, "base_failed", "kept", "outlyingness")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    names = docs.columns
    key = row_key(id_col, text_col)
    # Language and source belong to the key: the same text may be usual in one and odd in another.
    key = F.xxhash64(key, F.coalesce(F.col(lang_col).cast("string"), F.lit("\0")), F.lit("|"), F.coalesce(F.col(source_col).cast("string"), F.lit("\0")))
    judged = stage(_verdicts(docs, [key.alias("key_")], text_col, lang_col, source_col).select("key_", "kept"), "judged")
    gone = small(judged.filter("not kept").select("key_").distinct(), "rejected")
    rows = docs.select(F.struct(*(F.col(c) for c in names)).alias("row_"), key.alias("key_"))
    return rows.join(bounded(gone, REJECTED), "key_", "left_anti").select("row_.*")
