"""Spelling variants: words that one edit tells apart, found by asymmetric q-chunks.

Of two words one edit apart, let the longer (or either of two equally long) contribute chunks and the other grams.  The
longer word is cut into two disjoint chunks; one edit spoils one of them at most, so the other stands in the shorter word
too, shifted by one at most: by nothing if the edit comes after it, by the difference of the lengths if before.  Of the
shorter word's positional grams only those can match that stand at such a place and are as long as a chunk of a word of
its own length, or of one more.  Chunks and grams meet by equality; an edit distance of one is verified in the join.

Words can share a chunk in great numbers.  Where the pairs of a chunk would exceed ``CROWD``, its words are not joined
there: the part beside the chunk, the hole, in which the edit must be, is cut into two chunks in turn, and the words meet
by the old chunk together with a new one.  A hole of one code point is cut no further: words that agree in all else number
no more than there are letters.  So no pair is lost and no crowd is joined with itself.

Defined cases: null and empty texts have no words; without an id no code point is deleted; repeated rows count each; of
forms with equal counts the first in code-point order is taken; empty tables give no rows; other columns are not looked
at.  A run as long as a text is a word like any other.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word is a variant of a near word that occurs so many times as often.
RATIO = 5
#: A code point goes from a run whose hash this divides.
DAMAGE = 199
#: Pairs of words with the same chunk that are compared there.
CROWD = 4096


def damaged(run: Column, id_col: str, every: int = DAMAGE) -> Column:
    """The run, or without one code point where ``every`` divides the CRC-32 of id and run."""
    hashed = F.coalesce(F.crc32(F.concat(F.col(id_col).cast("string"), F.lit(":"), run)), F.lit(1))
    at = (hashed % F.length(run)).cast("int")
    rest = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
    return F.when(hashed % every == 0, rest).otherwise(run)


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough."""
    lowered = F.translate(F.col(text), UPPER, LOWER)
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    # Damage only shortens a run.
    words = runs.where(F.length("run") >= least_length).select(damaged(F.col("run"), "id").alias("word"))
    counts = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


def _signed(rows: DataFrame) -> DataFrame:
    """(word, n, longer, low, high, key): ``key`` stands for what is outside the hole, and where.

    ``longer`` is the length of the longer word, in whose places the hole is told; one that is shorter by one has its
    hole shorter by one.
    """
    short = F.col("longer") - F.length("word")
    head = F.expr("substring(word, 1, low)")
    tail = F.col("word").substr(F.col("high") - short + 1, F.length("word"))
    return rows.withColumn("key", F.xxhash64("longer", "low", "high", head, tail))


def _cut(rows: DataFrame) -> DataFrame:
    """Every hole as its two halves: keeping the first as a chunk, the edit is in the second, and the other way round."""
    middle = F.col("low") + F.expr("(high - low) div 2")
    holes = F.array(
        F.struct(middle.alias("low"), F.col("high").alias("high")), F.struct(F.col("low").alias("low"), middle.alias("high"))
    )
    cut = rows.select("word", "n", "longer", F.explode(holes).alias("hole"))
    return _signed(cut.select("word", "n", "longer", "hole.low", "hole.high"))


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(longer, longer_n, shorter, shorter_n): all pairs of distinct words one insertion, deletion or replacement apart."""
    length = F.length("word")
    whole = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("longer"))
    rows = _cut(whole.select("*", F.lit(0).alias("low"), F.col("longer").alias("high")))
    chunks = F.col("longer") == length
    ready: list[DataFrame] = []
    while True:
        rows = written(rows, f"chunks-{len(ready)}")
        sizes = rows.groupBy("key").agg(F.sum(chunks.cast("long")).alias("chunks"), F.count(F.lit(1)).alias("all"))
        many = (F.col("chunks") * F.col("all") > crowd).alias("many")
        crowded = written(sizes.where(many).select("key"), f"crowded-{len(ready)}")
        if crowded.isEmpty():
            ready.append(rows)
            break
        last = F.col("high") - F.col("low") <= 1
        ready.append(rows.join(crowded, "key", "left_anti").unionByName(rows.where(last).join(crowded, "key", "left_semi")))
        rows = _cut(rows.where(~last).join(crowded, "key", "left_semi").drop("key"))

    found = reduce(DataFrame.unionByName, ready)
    left = found.where(chunks).select("key", F.col("word").alias("longer"), F.col("n").alias("longer_n"))
    right = found.select("key", F.col("word").alias("shorter"), F.col("n").alias("shorter_n"))
    # Of two words of one length, each of which has both, the pair is taken one way.
    order = (F.length("longer") > F.length("shorter")) | (F.col("longer") < F.col("shorter"))
    one_edit = F.levenshtein("longer", "shorter", 1) == 1
    met = left.join(right, (left["key"] == right["key"]) & order & one_edit)
    return met.select("longer", "longer_n", "shorter", "shorter_n").dropDuplicates(["longer", "shorter"])


def _roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root) for the words that have a ``form``, by pointer jumping.

    A form occurs ``ratio`` times as often as its word, which bounds the chain and so the number of rounds.
    """
    longest = max(1, ceil(log(max(most, ratio), ratio)))
    roots = written(forms.select("word", F.col("form").alias("root")), "roots-0")
    for turn in range(ceil(log2(longest + 1))):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        jumped = roots.join(on, "root", "left").select("word", F.coalesce("farther", "root").alias("root"))
        roots = written(jumped, f"roots-{turn + 1}")
    return roots


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", crowd: int = CROWD, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of the texts."""
    words = written(vocabulary(docs, id_col, text), "words")
    pairs = written(near_pairs(words, crowd), "near-words")
    ways = [("longer", "shorter"), ("shorter", "longer")]
    both = reduce(
        DataFrame.unionByName,
        [pairs.select(F.col(a).alias("word"), F.struct((-F.col(f"{b}_n")).alias("n"), F.col(b).alias("word")).alias("near")) for a, b in ways],
    )
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("best"))
    held = -F.col("best.n") >= F.col("n") * ratio
    described = written(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(held, F.col("best.word")).alias("form"),
            F.when(held, -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    most = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(described.where(F.col("form").isNotNull()), most, ratio)
    return described.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
