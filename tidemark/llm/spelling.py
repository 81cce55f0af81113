"""Words grouped with their spelling variants, by asymmetric q-chunks.

Two words are near when one inserted, deleted or replaced code point turns one into the other. The longer word (of two
equally long ones either) contributes two disjoint chunks, its halves; the other contributes positional grams as long
as those halves. One edit touches one half, so the other is a gram of the shorter word, at its own place or, behind a
deletion, one place to the left: chunks and grams are joined on their letters and on a place that differs by no more than
one. Grams farther away can meet no chunk and are not posted. What lies outside the chunk then verifies a pair.

A chunk that many words share, such as a common beginning, must not become all pairs of its words. What the two words of
a pair differ in lies outside the chunk, and is again one edit: where a chunk's pairs would exceed a limit, the
rest of each word is cut by the same rule, and the words meet on both chunks. That goes on until chunks are small or
the rest is one letter, when every pair is near. No pair is lost, and none is made that shares less than asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import common

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PAIRS = 2_000   # of one chunk, beyond which the rest of its words is cut again


def word_counts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", every: int = 97, min_length: int = 5,
                min_count: int = 3) -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z lower-cased, of at least so many code points and occurrences.

    A run whose hash with its document's id is divisible by `every` loses one letter first, which the hash names. Counts
    are combined before the shuffle, so a word that makes up a third of all texts costs one row a task.
    """
    text = F.translate(F.col(f"`{text_column}`"), UPPER, LOWER)
    runs = df.select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.char_length("run").alias("length"), F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.col("length")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("length")))
    words = hashed.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _piece(text: Column, start: Column, length: Column) -> Column:
    return F.substring(text, (start + 1).cast("int"), length.cast("int"))


def _cuts(size: Column, behind: int) -> list[tuple[int, Column, Column, Column, Column]]:
    """(which half, start and length of the piece, start and length of the rest) in a word that is `behind` letters shorter
    than the word of `size` letters whose halves are meant."""
    half, nought = F.floor(size / 2), F.lit(0)
    return [(0, nought, half, half, size - behind - half), (1, half - behind, size - half, nought, half - behind)]


def _posted(rows: DataFrame, behind: int) -> DataFrame:
    """Pieces of the words' rests that meet halves of rests longer by `behind`; the key grows by the piece."""
    size = F.char_length("rest") + behind
    made = [F.struct(F.concat_ws("|", "key", size.cast("string"), F.lit(str(place)), _piece(F.col("rest"), start, length)).alias("key"),
                     _piece(F.col("rest"), other, left).alias("rest")) for place, start, length, other, left in _cuts(size, behind)]
    return rows.select("word", "n", F.lit(behind).alias("behind"), F.explode(F.array(*made)).alias("p")).select("word", "n", "behind", "p.key", "p.rest")


def _grams(rows: DataFrame, first: bool) -> DataFrame:
    """Grams for partners of equal length and for partners longer by one. The lengths of a pair are settled by the first cut."""
    if first:
        return _posted(rows, 0).union(_posted(rows, 1))
    return _posted(rows.where("behind = 0"), 0).union(_posted(rows.where("behind = 1"), 1))


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(x, nx, y, ny) of all near pairs of distinct words (word, n), each once; x is the longer or the smaller one."""
    start = words.select("word", "n", F.lit("").alias("key"), F.col("word").alias("rest"))
    chunks, grams, found, first, old = start, start, [], True, []
    while True:
        chunks = common.staged(_posted(chunks, 0), "spelling-chunks")
        grams = common.staged(_grams(grams, first), "spelling-grams")
        # how many words share each key, of either side; rests of one letter are pairs already
        sizes = (chunks.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max(F.char_length("rest")).alias("longest"))
                 .join(grams.groupBy("key").agg(F.count(F.lit(1)).alias("g")), "key"))
        keys = common.staged(sizes.select("key", ((F.col("c") * F.col("g") > pairs) & (F.col("longest") > 1)).alias("hot")), "spelling-keys")
        common.remove(chunks.sparkSession, *old)
        x, y = (t.join(keys, "key") for t in (chunks, grams))
        x, y = (t.where("not hot").select("key", F.col("word").alias(a), F.col("n").alias(f"n{a}"), F.col("rest").alias(f"rest_{a}"), "behind")
                for t, a in ((x, "x"), (y, "y")))
        met = x.drop("behind").join(y, "key").where("(behind = 1 or x < y) and levenshtein(rest_x, rest_y, 1) = 1")
        found.append(common.staged(met.select("x", "nx", "y", "ny"), "spelling-near"))
        hot = keys.where("hot").select("key")
        old = [chunks, grams, keys]
        if hot.isEmpty():
            break
        chunks, grams, first = chunks.join(hot, "key", "left_semi"), grams.join(hot, "key", "left_semi"), False
    common.remove(chunks.sparkSession, *old)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: counts at least double at each step, so chains are short; jumps double."""
    now = common.staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        over = now.select(F.col("word").alias("root"), F.col("root").alias("over"))
        moved = now.join(over, "root", "left").select("word", F.coalesce("over", "root").alias("root"), F.col("over").isNotNull().alias("moved"))
        out = common.staged(moved, "spelling-roots")
        common.remove(forms.sparkSession, now)
        now = out.drop("moved")
        now.staged_at = out.staged_at
        if out.where("moved").isEmpty():
            return now


def spelling_variants(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", every: int = 97, min_length: int = 5,
                      min_count: int = 3, ratio: int = 2, pairs: int = PAIRS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of the texts.

    A word's form is its near word of largest n, of equal ones the first in code-point order, if that n is at least
    `ratio` times its own (2 or more, so that no chain of forms returns). Its root is the last of the chain of forms, or
    the word itself. Null and empty texts have no words; a null id counts as an empty one; repeated rows count each; an
    empty table gives no rows. Other columns of `df` are not read.
    """
    if ratio < 2:
        raise ValueError("forms must outnumber their variants, or chains of forms need not end")
    common.tune(df.sparkSession)
    words = common.staged(word_counts(df, id_column, text_column, every, min_length, min_count), "spelling-words")
    near = near_pairs(words, pairs)
    ways = near.select(F.col("x").alias("word"), F.col("nx").alias("n"), F.col("y").alias("other"), F.col("ny").alias("m")).union(
        near.select("y", "ny", "x", "nx"))
    best = ways.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    fits = -F.col("best.m") >= ratio * F.col("n")
    named = common.staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n")), "spelling-forms")
    roots = _roots(named.where("form is not null"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(common.read(spark, sf_dir, "documents"))


QUERIES = {"op11_spelling_variants": op11_spelling_variants}
# The checksum is worked out byte by byte from its polynomial; near words meet on what one deleted letter leaves of them.
ORACLE = {"op11_spelling_variants": r"""
WITH RECURSIVE polynomial AS (
    SELECT list(c ORDER BY i) AS steps FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
        FROM range(256) t(i))),
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
held AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, run, count(*) AS times FROM runs GROUP BY ALL),
hashed AS (
    SELECT run, times, length(run) AS size, xor(4294967295, list_reduce(
        list_prepend(4294967295, flatten(list_transform(string_split(named, ''), lambda c:
            CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [(192 + unicode(c) // 64)::BIGINT, (128 + unicode(c) % 64)::BIGINT] END))),
        lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1]))) AS h
    FROM held, polynomial),
spelt AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % size) || substr(run, h % size + 2) ELSE run END AS word, times FROM hashed),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
ways AS (
    SELECT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, n, count(*) AS n_near, max(m) AS m FROM ways GROUP BY word, n),
forms AS (
    SELECT b.word, min(w.other) AS form, b.m AS form_n FROM best b JOIN ways w ON w.word = b.word AND w.m = b.m
    WHERE b.m >= 2 * b.n GROUP BY b.word, b.m),
chain AS (
    SELECT word, form AS top FROM forms
    UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.top = f.word)
SELECT w.word, f.form, coalesce(r.top, w.word) AS root, w.n, CAST(coalesce(b.n_near, 0) AS BIGINT) AS n_near, f.form_n
FROM words w LEFT JOIN best b ON w.word = b.word LEFT JOIN forms f ON w.word = f.word
LEFT JOIN (SELECT word, top FROM chain WHERE top NOT IN (SELECT word FROM forms)) r ON w.word = r.word"""}
