"""Similar club names: spellings one letter apart, found without comparing all names.

Every folded name stands for itself and for the names that are left when one character is dropped. Two names
one edit apart (a letter more, fewer or another) share such a form, so an equality join on the forms gives
all candidates; Levenshtein's distance then decides. A form belongs to few names (a character more at one of
its places), so no key of the join is hot, whatever the number of clubs or records.

``club_groups`` gives each name a club to be counted under: the similar name with the most records (ties:
the first by code point), followed until a name that no similar name outranks. Names in a chain that rises in
records are one group; the end of every chain is itself a name in the data.

Defined results: records are counted per folded name before anything else; null clubs and names without
letters or digits are left out; names shorter than ``MIN_LENGTH`` are similar to nothing, nor are names with
different digits ('club 1', 'club 2'); an empty frame gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .quality import fold_club

#: Characters of a name below which one letter more or less says nothing.
MIN_LENGTH = 4


def club_counts(df: DataFrame, club: str = "club") -> DataFrame:
    """club_key, n: records per folded name."""
    keys = df.filter(F.col(club).isNotNull()).select(fold_club(F.col(club)).alias("club_key"))
    return keys.filter("club_key <> ''").groupBy("club_key").agg(F.count(F.lit(1)).alias("n"))


def _forms(key: Column) -> Column:
    """The name and all names with one character less."""
    n = F.length(key)
    less = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(key, F.lit(1), i - 1), F.substring(key, i + 1, n)))
    return F.array_distinct(F.concat(F.array(key), less))


def similar_pairs(counts: DataFrame) -> DataFrame:
    """club_key_a, club_key_b, n_a, n_b: names one edit apart, a before b by code point, each pair once."""
    named = counts.filter(F.length("club_key") >= MIN_LENGTH)
    digits = F.regexp_replace("club_key", r"[^0-9]", "")
    forms = named.select("club_key", "n", digits.alias("digits"), F.explode(_forms(F.col("club_key"))).alias("form"))
    a, b = forms.alias("a"), forms.alias("b")
    same = (F.col("a.form") == F.col("b.form")) & (F.col("a.digits") == F.col("b.digits")) & (F.col("a.club_key") < F.col("b.club_key"))
    pairs = a.join(b, same).filter(F.levenshtein("a.club_key", "b.club_key", 1) == 1)
    return pairs.select(F.col("a.club_key").alias("club_key_a"), F.col("b.club_key").alias("club_key_b"),
                        F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b")).distinct()


def dq_similar_clubs(df: DataFrame, club: str = "club") -> DataFrame:
    """Pairs of similar club names with their record counts."""
    return similar_pairs(cut_lineage(club_counts(df, club)))


def club_groups(df: DataFrame, club: str = "club") -> DataFrame:
    """club_key, n, group_key: every folded name with the name it is counted under."""
    counts = cut_lineage(club_counts(df, club))
    pairs = similar_pairs(counts)
    both = pairs.union(pairs.select("club_key_b", "club_key_a", "n_b", "n_a")).toDF("club_key", "other", "n", "n_other")
    above = both.filter("n_other > n OR (n_other = n AND other < club_key)")
    # The most records first, then the smallest name.
    parent = above.groupBy("club_key").agg(F.min_by("other", F.struct((-F.col("n_other")).alias("less"), "other")).alias("parent"))
    top = cut_lineage(counts.join(parent, "club_key", "left").withColumn("parent", F.coalesce("parent", "club_key")))
    while True:  # each round doubles the steps taken; ranks rise along a chain, so it ends
        up = top.select(F.col("club_key").alias("parent"), F.col("parent").alias("next"))
        far = cut_lineage(top.join(up, "parent").select("club_key", "n", F.col("next").alias("parent"), (F.col("next") != F.col("parent")).alias("moved")))
        top = far.drop("moved")
        if far.filter("moved").isEmpty():
            return top.withColumnRenamed("parent", "group_key")
