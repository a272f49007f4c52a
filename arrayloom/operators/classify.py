"""Repeat classes, their names and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrayloom.functions.seqfn import count_of, rounded

from .orders import places

#: Base counts are columns, computed once for all predicates and names.
A, C, G, T = (lambda b=b: F.col(f"_n_{b}") for b in "ACGT")
SIZES = (1000, 10000, 100000, 1000000)


def with_counts(sat: DataFrame) -> DataFrame:
    return sat.withColumns({f"_n_{b}": count_of(F.upper("trf_array"), b) for b in "ACGT"})


def perfect_micro() -> Column:
    return (F.col("trf_period") < 6) & (F.col("trf_pmatch") == 100)


def micro() -> Column:
    return F.col("trf_period") < 6


def true_ssr() -> Column:
    """At least one base is absent."""
    return F.least(A(), C(), G(), T()) == 0


def rare(n: Column) -> Column:
    return (n < 4) | (n / F.length("trf_array") < 0.01)


def fuzzy_ssr() -> Column:
    """At least one base is rare: under 1 % or fewer than four."""
    return rare(A()) | rare(C()) | rare(G()) | rare(T())


def complex_repeat() -> Column:
    return F.coalesce(
        (F.length("trf_consensus") > 4)
        & (F.col("trf_array_length") > 100)
        & (F.col("trf_pmatch") < 100)
        & (F.col("trf_array_gc") > 0.2)
        & (F.col("trf_array_gc") < 0.8)
        & (F.col("trf_n_copy") > 4)
        & (F.col("trf_entropy") > 1.82),
        F.lit(False),
    )


def micro_name() -> Column:
    return F.concat(F.lit("("), F.upper("trf_consensus"), F.lit(")n"))


# Names of the sets of bases that can be present, for one of each pair of complementary sets.
BASE_SETS = ("ACG", "ACT", "AGT", "AC", "AG", "AT", "CG", "C", "A")


def ssr_name(prefix: str, a: Column, c: Column, g: Column, t: Column) -> Column:
    """Name by the bases present; complementary sets share a name, all four count as the first set; null for none.

    The set is a number of four bits, and a table of 16 names says what it is called."""
    names: dict[int, str] = {}
    bit = {"A": 1, "C": 2, "G": 4, "T": 8}
    for n in BASE_SETS:
        for word in (n, n.translate(str.maketrans("ACGT", "TGCA"))):
            names.setdefault(sum(bit[x] for x in word), f"{prefix}_{n}")
    names[15] = f"{prefix}_{BASE_SETS[0]}"
    present = sum((F.coalesce(x, F.lit(False)).cast("int") * bit[b] for b, x in zip("ACGT", (a, c, g, t), strict=True)), F.lit(0))
    return F.element_at(F.array(*[F.lit(names.get(k)) for k in range(16)]), present + 1)


def true_ssr_name() -> Column:
    return ssr_name("tSSR", A() > 0, C() > 0, G() > 0, T() > 0)


def fuzzy_ssr_name() -> Column:
    return ssr_name("fSSR", ~rare(A()), ~rare(C()), ~rare(G()), ~rare(T()))


def classify(sat: DataFrame, predicate: Column, name: Column) -> DataFrame:
    """Rows of one class with their family name."""
    return with_counts(sat).where(predicate).withColumn("trf_family", name).drop(*[f"_n_{b}" for b in "ACGT"])


def separated(sat: DataFrame, predicate: Column, name: Column, line: Column, path: str, digits: int = 2) -> DataFrame:
    """One class of repeats, named and in order of its sequences and places, written as lines (gff3_line or another form) to
    path; returns its statistics by family."""
    rows = classify(sat, predicate, name)
    rows.orderBy("trf_head", "trf_l_ind", "trf_r_ind", "trf_id").select(line.alias("value")).write.mode("overwrite").text(path)
    return family_statistics(rows, digits)


def all_classes(sat: DataFrame) -> DataFrame:
    """One row per repeat and class, in one pass over the table: category, trf_family and the repeat's columns."""
    both = lambda when, category, name: F.when(when, F.struct(F.lit(category).alias("category"), name.alias("trf_family")))
    none = F.lit(None).cast("string")
    kinds = [
        both(perfect_micro(), "pmicro", micro_name()),
        both(micro(), "micro", micro_name()),
        both(true_ssr(), "tSSR", true_ssr_name()),
        both(fuzzy_ssr(), "fSSR", fuzzy_ssr_name()),
        both(complex_repeat(), "complex", none),
        *[both(F.col("trf_array_length") > n, f"{n // 1000}kb", none) for n in SIZES],
    ]
    found = with_counts(sat).withColumn("_k", F.explode(F.array_compact(F.array(*kinds))))
    return found.select("*", "_k.category", "_k.trf_family").drop("_k", *[f"_n_{b}" for b in "ACGT"])


def category_summary(classes: DataFrame, genome_size: DataFrame) -> DataFrame:
    """Per category: n, total_length, pgenome (% of the genome, three decimals); genome_size: one row, column genome."""
    sums = classes.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("trf_array_length").alias("total_length"))
    return sums.crossJoin(F.broadcast(genome_size)).select("category", "n", "total_length", rounded(100.0 * F.col("total_length") / F.col("genome"), 3).alias("pgenome"))


def family_statistics(classes: DataFrame, digits: int = 2) -> DataFrame:
    """Per family: count; total, least, greatest, mean and population deviation of length; the same of match and GC %."""
    gc = 100 * F.col("trf_array_gc")
    out = [F.count(F.lit(1)).alias("n"), F.sum("trf_array_length").alias("total_length")]
    for col, name in ((F.col("trf_array_length"), "length"), (F.col("trf_pmatch"), "pmatch"), (gc, "gc")):
        out += [f(col).alias(f"{k}_{name}") for f, k in ((F.min, "min"), (F.max, "max"))]
        out += [rounded(f(col), digits).alias(f"{k}_{name}") for f, k in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    return classes.groupBy("trf_family").agg(*out)


def micro_summary(classes: DataFrame) -> DataFrame:
    """Per name: count, summed span, % imperfect, % perfect."""
    perfect = 100.0 * F.count_if(F.col("trf_pmatch") == 100) / F.count(F.lit(1))
    return classes.groupBy("trf_family").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs(F.col("trf_r_ind") - F.col("trf_l_ind"))).alias("span"), rounded(100 - perfect, 2).alias("imperfect"), rounded(perfect, 2).alias("perfect")
    )


def family_info(families: DataFrame) -> DataFrame:
    """families(family, start, bp, core, consensus): n, bp, core bp and first consensus of each, ranked by core bp."""
    by = families.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.sum("bp").alias("bp"), F.sum(F.when(F.col("core"), F.col("bp")).otherwise(0)).alias("core_bp"), F.min_by("consensus", F.struct("start", "consensus")).alias("consensus"))
    return places(by, [F.desc("core_bp"), F.col("family")], "rank").withColumn("rank", (F.col("rank") + 1).cast("int"))


def family_members(table: DataFrame) -> DataFrame:
    """Rows of families.family_table as family_info takes them."""
    return table.select("family", "start", F.col("array_length").alias("bp"), (F.col("source") == "core").alias("core"), "consensus")


def with_attributes(repeats: DataFrame, classified: DataFrame, key: str = "trf_id") -> DataFrame:
    """repeats whose columns take the values of the row of classified with the same key, where both have a column of that name
    and there is such a row (its nulls as well); other columns of classified are not read. Of rows of classified with one key the
    least one counts; a null key matches nothing."""
    shared = [c for c in repeats.columns if c != key and c in classified.columns]
    if not shared:
        return repeats
    one = classified.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(*shared)).alias("_new"))
    found = repeats.join(one, F.col(key) == F.col("_key"), "left")
    return found.select(*[F.when(F.col("_key").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in shared else F.col(c) for c in repeats.columns])


def run_summary(log: DataFrame) -> DataFrame:
    """One row of a run log(status, seconds): runs that succeeded, failed and were skipped, mean seconds of the first."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return log.agg(n("success"), n("failed"), n("skipped"), F.round(F.avg(F.when(F.col("status") == "success", F.col("seconds"))), 4).alias("mean_seconds"))
