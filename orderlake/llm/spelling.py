"""Spelling variants: words one edit apart, by a trie-node pair dictionary.

The distinct prefixes of all words are the nodes of a trie, their distinct suffixes those of
the trie of reversed words; both are numbered. A word cut at position i is the integer pair
(node of the prefix before i, node of the suffix from i); skipping the letter at i gives the
pair (node of the prefix before i, node of the suffix after i). Nodes stand for strings one
to one, so equal pairs are equal strings in equal places, and a grouping by pair is exact:

* two words with the same skipping pair differ in that letter only;
* a skipping pair that equals another word's cut is that word with a letter inserted.
  A letter in a run of equal ones can be skipped at any place of the run; only the first
  counts, so a pair of words meets once.

The words of a pair differ in one letter, so a pair has at most as many words as there are
letters. No pairs of words are made: a pair tells each of its words how many others it holds
and which of them is most frequent, and a word adds up what it is told. Words are numbered by
falling frequency, so the best neighbour is the smallest number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import prepare, stored

# ---- fixed values: letters that make words, and those that are lower-cased ----
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# --------------------------------------------------------------------------------


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def runs_of(docs: DataFrame, shortest: int, id_col: str, text_col: str) -> DataFrame:
    """(id, run): each run of at least ``shortest`` letters of each text, lower-cased."""
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))
    return docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")
    ).select("id", lower_ascii(F.col("run")).alias("run"))


def with_slips(runs: DataFrame, every: int = 199) -> DataFrame:
    """(word): the runs, where the hash of document and run decides that a letter is lost."""
    slip = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (slip % F.length("run")).cast("int")
    return runs.select("run", slip.alias("_slip"), at.alias("_at")).select(
        F.when(
            F.col("_slip") % every == 0,
            F.concat(F.expr("substring(run, 1, _at)"), F.expr("substring(run, _at + 2)")),
        ).otherwise(F.col("run")).alias("word")
    )


def counted(words: DataFrame, shortest: int = 6, least: int = 5) -> DataFrame:
    """(word_id, word, n) of words that are long and frequent enough, stored.

    Numbers rise with falling frequency; words of equal frequency are in code-point order.
    """
    frequent = (
        words.where(F.length("word") >= shortest)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
    )
    ordered = frequent.orderBy(F.col("n").desc(), "word")
    return stored(ordered.select(F.monotonically_increasing_id().alias("word_id"), "word", "n"), "words")


def numbered(strings: DataFrame, name: str) -> DataFrame:
    """(name, node): the distinct non-empty strings of a column, numbered from 1, stored.

    The numbers are written once and read from then on, so a lost executor changes none.
    """
    distinct = strings.where(F.col(name) != "").distinct()
    return stored(distinct.select(name, (F.monotonically_increasing_id() + 1).alias("node")), f"{name}-trie")


def node_pairs(words: DataFrame) -> DataFrame:
    """(word_id, cuts): for each position of a word the nodes p of the prefix before it and s
    of the suffix from it, and whether its letter differs from the one before (``opens``).

    The empty string is node 0.
    """
    # One row a (word, position) with the strings on both sides of it.
    cuts = stored(
        words.select("word_id", "word", F.explode(F.expr("sequence(0, length(word))")).alias("at")).select(
            "word_id",
            "at",
            F.expr("substring(word, 1, at)").alias("before"),
            F.expr("substring(word, at + 1)").alias("after"),
            F.expr("at = 0 or substring(word, at, 1) <> substring(word, at + 1, 1)").alias("opens"),
        ),
        "cuts",
    )
    forward = numbered(cuts.select("before"), "before").withColumnRenamed("node", "_p")
    backward = numbered(cuts.select("after"), "after").withColumnRenamed("node", "_s")
    return (
        cuts.join(forward, "before", "left").join(backward, "after", "left")
        .select("word_id", "at", F.coalesce("_p", F.lit(0)).alias("p"), F.coalesce("_s", F.lit(0)).alias("s"), "opens")
        .groupBy("word_id")
        .agg(F.sort_array(F.collect_list(F.struct("at", "p", "s", "opens"))).alias("cuts"))
    )


def neighbours(words: DataFrame) -> DataFrame:
    """(word_id, n_near, best) of the words that are one inserted, deleted or replaced letter
    from another: how many such words there are, and the most frequent one's number.

    A group holds words that differ in one letter, and at most one that lacks it.
    """
    whole = "transform(cuts, c -> struct(c.p AS p, c.s AS s, false AS skips, false AS opens))"
    skipping = """transform(slice(cuts, 1, size(cuts) - 1),
        (c, i) -> struct(c.p AS p, cuts[i + 1].s AS s, true AS skips, c.opens AS opens))"""
    members = node_pairs(words).select("word_id", F.expr(f"inline(concat({whole}, {skipping}))"))
    groups = (
        members.groupBy("p", "s")
        .agg(
            F.min(F.when(~F.col("skips"), F.col("word_id"))).alias("short"),
            F.sort_array(F.collect_list(F.when(F.col("skips"), F.struct("word_id", "opens")))).alias("longer"),
        )
        .where("size(longer) + if(short is null, 0, 1) > 1")
    )
    # To a longer word: the others of its length, and the shorter one where its letter opens a
    # run. To the shorter word: the longer ones whose letter opens a run.
    told = groups.withColumn("opening", F.expr("filter(longer, w -> w.opens)")).select(
        F.expr("""inline(concat(
            transform(longer, (w, i) -> struct(
                w.word_id AS word_id,
                size(longer) - 1 + if(w.opens and short is not null, 1, 0) AS n,
                least(
                    case when i > 0 then longer[0].word_id when size(longer) > 1 then longer[1].word_id end,
                    case when w.opens then short end) AS best)),
            if(short is null or size(opening) = 0, array(), array(struct(
                short AS word_id, size(opening) AS n, opening[0].word_id AS best)))))""")
    )
    return (
        told.where("n > 0").groupBy("word_id")
        .agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))
    )


def forms(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of (word_id, word, n).

    A word's form is its most frequent neighbour if that is ``ratio`` times as frequent, else
    null. The root is the last of the forms of forms: each is ``ratio`` times as frequent as
    the one before, so doubling the steps at each round ends after a few.
    """
    other = words.select(F.col("word_id").alias("best"), F.col("word").alias("_form"), F.col("n").alias("_n"))
    steps = stored(
        words.join(neighbours(words), "word_id", "left").join(other, "best", "left").select(
            "word_id", "word", "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("_n") >= ratio * F.col("n"), F.struct("best", "_form", "_n")).alias("_to"),
        ),
        "forms",
    )
    up = stored(steps.where("_to is not null").select("word_id", F.col("_to.best").alias("to")), "roots")
    while True:
        further = up.join(up.select(F.col("word_id").alias("to"), F.col("to").alias("next")), "to", "left")
        moved = stored(
            further.select(
                "word_id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        up = moved.select("word_id", "to")
        if moved.where("moved").isEmpty():
            break
    root = words.select(F.col("word_id").alias("to"), F.col("word").alias("_root"))
    return steps.join(up, "word_id", "left").join(root, "to", "left").select(
        "word",
        F.col("_to._form").alias("form"),
        F.coalesce("_root", "word").alias("root"),
        "n",
        "n_near",
        F.col("_to._n").alias("form_n"),
    )


def spelling_variants(
    docs: DataFrame,
    *,
    shortest: int = 6,
    least: int = 5,
    ratio: int = 5,
    slips: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all texts.

    Words are maximal runs of letters, A-Z lower-cased, of at least ``shortest`` letters that
    occur at least ``least`` times. With ``slips`` a letter of every so manieth run (by the
    hash of document id and run; a null id counts as empty) is lost before counting. Null and
    empty texts have no words; repeated rows count again; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    runs = runs_of(docs, shortest, id_col, text_col)
    words = with_slips(runs, slips) if slips else runs.select(F.col("run").alias("word"))
    return forms(counted(words, shortest, least), ratio)
