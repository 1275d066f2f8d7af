"""Spelling variants (operator 12): words at one edit from each other, by the sorted rotations of a permuterm index.

A word w with a terminator has len(w) + 1 rotations. Turned so that the edited character comes last, two words that differ in it share
all before it: for w = a x b these are the rotations b$a x and b$a y (a replacement), and the rotation b$a of the word a b
itself (an insertion or deletion). So each rotation is filed twice: whole, as the word that has nothing in the gap, and without its
last character, as one that has that character there. Rotations sorted by what they share stand in groups, a window scans each, and every
word takes from its group how many others it has and the best of them; no pairs are made. A group has one word at most
for each character and one with none: its size is bounded by the alphabet, whatever the corpus.

A pair of a replacement meets in one group. A pair of an insertion meets once for every place of the run of equal characters
that the inserted one joins; only the first place of the run counts.

Each word's form is its most frequent neighbour if that is FACTOR times as frequent. Following forms to the end is pointer doubling over
written tables; counts grow with each step, so there are no circles and few rounds.

Defined cases: null texts have no words; words under `least` code points or seen less than `times` times are none; repeated documents count again.
The terminator, U+0000, is in no word of count_words(); rows of other tables that hold it have no neighbours. An empty table gives no rows.
Other columns stay out.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.common import discard, written, written_at

LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FACTOR = 10


def runs_of(docs: DataFrame, text: str = "text", least: int = 7) -> DataFrame:
    """docs without its text, a row for each maximal run of at least `least` letters: `run`, A-Z lower-cased."""
    run = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0)))
    found = docs.select(*[c for c in docs.columns if c != text], run.alias("run"))
    return found.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run")))


def count_words(runs: DataFrame, word: Column, least: int = 7, times: int = 2) -> DataFrame:
    """(word, n): how often each word of at least `least` code points occurs, if at least `times` times."""
    return runs.select(word.alias("word")).filter(F.char_length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= times)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best): of each word (word, n) with neighbours how many it has, and (minus n, word) of the most frequent, of equals the first."""
    rotated = "concat(substring(word, i + 1), '\\0', substring(word, 1, i))"
    shared = "concat(substring(word, i + 1), '\\0', substring(word, 1, i - 1))"
    first = "i = 1 OR substring(word, i, 1) != substring(word, i - 1, 1)"
    filed = f"""inline(flatten(transform(sequence(0, char_length(word)), i -> CASE WHEN i = 0 THEN array(named_struct('key', {rotated}, 'filled', false, 'counts', false))
        ELSE array(named_struct('key', {rotated}, 'filled', false, 'counts', false), named_struct('key', {shared}, 'filled', true, 'counts', {first})) END)))"""
    rows = words.filter("instr(word, '\\0') = 0").select(F.struct((-F.col("n")).alias("less"), "word").alias("me"), "word").selectExpr("me", filed)
    group = Window.partitionBy("key").orderBy(F.desc("filled"), "me").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled, counts = F.col("filled"), F.col("counts")
    rows = rows.select(
        "me", "filled", "counts", F.count("*").over(group).alias("all"), F.count_if(filled).over(group).alias("n_filled"), F.count_if(counts).over(group).alias("n_counting"),
        F.first("me").over(group).alias("first"), F.nth_value("me", 2).over(group).alias("second"), F.last("me").over(group).alias("last"), F.min(F.when(counts, F.col("me"))).over(group).alias("counting"),
    ).filter("all > 1")
    bare = F.col("all") > F.col("n_filled")  # the word with nothing in the gap is there: it is the last
    other = F.when(F.col("first") != F.col("me"), F.col("first")).when(F.col("n_filled") > 1, F.col("second"))
    near = F.when(filled, F.col("n_filled") - 1 + (bare & counts).cast("long")).otherwise(F.col("n_counting"))
    best = F.when(filled, F.array_min(F.array(other, F.when(bare & counts, F.col("last"))))).otherwise(F.col("counting"))
    return rows.select(F.col("me.word").alias("word"), near.alias("near"), best.alias("best")).filter("near > 0").groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for links (word, form) without circles: the end of each word's chain."""
    spark = forms.sparkSession
    links, old = written_at(forms.select("word", F.col("form").alias("root")), "spelling-links-0")
    for k in count(1):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found, new = written_at(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"spelling-links-{k}")
        discard(spark, old)
        links, old = found.select("word", "root"), new
        if found.filter("moved").limit(1).count() == 0:
            return links
    raise AssertionError


def group_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of words (word, n), which are distinct."""
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = neighbours(words).select("word", "n_near", F.col("best.word").alias("best"), (-F.col("best.less")).alias("best_n"))
    joined = words.join(near, "word", "left")
    has = F.col("best_n") >= factor * F.col("n")
    formed = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
