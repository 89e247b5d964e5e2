"""Spelling variants by asymmetric chunks: words one edit apart, and their forms.

A word of n code points is cut in two disjoint chunks. One inserted or replaced
code point leaves one of them whole, so the longer (or equally long) word holds
it as a positional gram, at the same place or shifted by one. The shorter word
writes its chunks, the other the grams at the places where a chunk can be, for
each partner length; an equi-join on (length, place of the edited span, hash of
the chunk) meets them, and the edit distance of what is left, then of the whole
words, verifies.

A chunk that many words share is not joined: where chunks times grams of a key
pass ``key_pairs``, its words cut the part that the edit must be in again, so
the key then holds one half of that part too (the same lemma). At the end the
edited part is one code point and a key's chunks differ in that alone, so groups
are bounded by the alphabet and no link is lost. Rows carry only the part that is
not yet in their key.

Defined results: null and empty texts have no words; a null id is the empty
text in the checksum; copies and repeated rows count as they occur; very long
words are words; ties of forms go to the smallest in code-point order; an empty
table gives no rows; other input columns are not read.
"""
from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stage, stage, text_of

LETTERS = "[A-Za-z\u00C0-\u00FF]"
KEY = ("n", "lo", "hi", "key")


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7,
                least_count: int = 2, every: int = 31) -> DataFrame:
    """(word, n) of the words with their counts: maximal letter runs with A-Z in
    lower case, a code point deleted where ``every`` divides the checksum."""
    # A run shorter than least_length can't match, so only whole longer runs do.
    found = F.regexp_extract_all(text_of(text_col), F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    run = F.translate("run", ascii_uppercase, ascii_lowercase)
    runs = runs.select(run.alias("run"), F.crc32(F.concat("id", F.lit(":"), run)).alias("h"),
                       F.char_length("run").alias("size"))
    at = (F.col("h") % F.col("size")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.col("size")))
    return (runs.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
            .filter(F.char_length("word") >= least_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count))


def _cut(sides: DataFrame) -> DataFrame:
    """Two rows for each: its span (``lo`` to ``hi`` of the shorter word, ``rest``
    in the row's own word) is cut in the middle, one half joins the key as a whole
    chunk and the edit is in the other. A word one longer than its partner's n has
    a span one longer, so the second half sits one further on there."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    first, size = middle - F.col("lo"), F.char_length("rest")
    second = size - (F.col("hi") - middle)

    def half(lo, hi, chunk, rest):
        return F.struct(lo.alias("lo"), hi.alias("hi"), F.xxhash64("key", chunk).alias("key"), rest.alias("rest"))

    rest = F.col("rest")
    halves = F.array(
        half(middle, F.col("hi"), rest.substr(F.lit(1), first), rest.substr(first + 1, size)),
        half(F.col("lo"), middle, rest.substr(second + 1, size), rest.substr(F.lit(1), second)))
    return sides.withColumn("half", F.explode(halves)).select("id", "chunk", "longer", "n", "half.*")


def near_pairs(words: DataFrame, key_pairs: int = 4096) -> tuple[DataFrame, list[str]]:
    """(a, a_n, b, b_n), each pair of words one edit apart once, and the staged
    tables that it reads. ``words``: distinct (id, word, n)."""
    whole = words.select("id", F.lit(0).alias("lo"), F.lit(0).cast("long").alias("key"), F.col("word").alias("rest"))
    chunks = whole.select("*", F.lit(True).alias("chunk"), F.lit(False).alias("longer"), F.char_length("rest").alias("n"))
    grams = (whole.select("*", F.lit(False).alias("chunk"), F.explode(F.array(F.lit(False), F.lit(True))).alias("longer"))
             .withColumn("n", F.char_length("rest") - F.col("longer").cast("int")))
    sides = chunks.unionByName(grams).withColumn("hi", F.col("n"))
    found, paths = None, []
    while True:
        keys, path = stage(_cut(sides))
        paths.append(path)
        met = (keys.groupBy(*KEY).agg(F.count_if("chunk").alias("chunks"), F.count_if(~F.col("chunk")).alias("grams"))
               # A word's chunk meets its own gram, so one of each is no pair.
               .filter("chunks > 0 and grams > 0 and chunks + grams > 2")
               .select(*KEY, ((F.col("chunks") * F.col("grams") > key_pairs) & (F.col("hi") - F.col("lo") > 1))
                       .alias("hot")))
        marked, path = stage(keys.join(met, list(KEY)))
        paths.append(path)
        cold = marked.filter(~F.col("hot"))
        short = cold.filter("chunk").select(*KEY, F.col("id").alias("a"), F.col("rest").alias("a_rest"))
        long = cold.filter(~F.col("chunk")).select(*KEY, F.col("id").alias("b"), F.col("rest").alias("b_rest"), "longer")
        pairs, path = stage(short.join(long, list(KEY))
                            .filter((F.col("longer") | (F.col("a") < F.col("b")))
                                    & (F.levenshtein("a_rest", "b_rest", 1) == 1)).select("a", "b"))
        paths.append(path)
        found = pairs if found is None else found.unionByName(pairs)
        sides = marked.filter("hot").drop("hot")
        if sides.isEmpty():
            break
    one, other = (words.select(F.col("id").alias(c), F.col("word").alias(f"{c}_word"), F.col("n").alias(f"{c}_n"))
                  for c in "ab")
    # Keys are hashes: the whole words decide.
    pairs, path = stage(found.distinct().join(one, "a").join(other, "b")
                        .filter(F.levenshtein("a_word", "b_word", 1) == 1)
                        .select(F.col("a_word").alias("a"), "a_n", F.col("b_word").alias("b"), "b_n"))
    drop_stage(words.sparkSession, *paths)
    return pairs, [path]


def _roots(forms: DataFrame) -> tuple[DataFrame, list[str]]:
    """(word, root) by doubling: forms grow by a factor, so chains are short."""
    now, path = stage(forms.select("word", F.col("form").alias("root")))
    paths = [path]
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved, path = stage(now.join(ahead, F.col("root") == F.col("at"), "left")
                            .select("word", F.coalesce("next", "root").alias("root"),
                                    F.col("next").isNotNull().alias("moved")))
        paths.append(path)
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now, paths


def group_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7,
                   least_count: int = 2, every: int = 31, factor: int = 10, key_pairs: int = 4096) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word: ``form`` is its near
    word of the largest count if that is at least ``factor`` times its own."""
    words, words_path = stage(count_words(df, id_col, text_col, least_length, least_count, every)
                              .withColumn("id", F.monotonically_increasing_id()))
    pairs, paths = near_pairs(words, key_pairs)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = F.col("best").isNotNull() & (-F.col("best.less") >= F.col("n") * factor)
    formed, formed_path = stage(words.join(best, "word", "left").select(
        "word", F.when(known, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(known, -F.col("best.less")).alias("form_n")))
    roots, more = _roots(formed.filter("form is not null"))
    result, _ = stage(formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
    drop_stage(df.sparkSession, words_path, formed_path, *paths, *more)
    return result
