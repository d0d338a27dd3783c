"""Quality rules in DataFrame functions: text statistics and cross-document lines.

A line's key is the hash of its source (the host) and its normalised form. Lines that
more than LINE_DOCS and more than LINE_SHARE of a source's distinct documents carry
are removed, and a document that loses over half its words is rejected. Documents
are told apart by their text, so that exact copies of a page count once and do not
make each other's lines common. A line that no other document has is never removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store

#: The white space between words, as a character class, and the symbols.
SPACE = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
REPEAT_PERCENT = 50
#: A common line is in more documents of its source than this, ...
LINE_DOCS = 20
#: ... and in more than one in so many of them.
LINE_SHARE = 50


def _let(value: Column, body) -> Column:
    """body(value), with value computed once even where body uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def _cover(places: Column) -> Column:
    """Words in the 3-word windows at the places: each covers up to three further ones."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).cast("bigint").alias("last"))
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3).cast("bigint"), p - a["last"])).alias("n"), p.alias("last"))
    return F.aggregate(F.sort_array(places), start, step, lambda a: a["n"])


def _sorted_windows(words: Column) -> Column:
    """As repeat_words, by the words themselves."""
    window = lambda k: F.struct(*(F.get(words, k + i).alias(f"w{i}") for i in range(3)), k.cast("bigint").alias("k"))
    same = lambda a, b: (a["w0"] == b["w0"]) & (a["w1"] == b["w1"]) & (a["w2"] == b["w2"])
    repeated = lambda s: F.filter(s, lambda v, k: same(v, F.get(s, k + 1)) | same(v, F.get(s, k - 1)))
    return _let(F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), window)), lambda s: _cover(F.transform(repeated(s), lambda v: v["k"])))


def repeat_words(words: Column, bits_kept: int = 64) -> Column:
    """Words in 3-word windows that the list holds twice or more, the first included.

    A window is a hash over its place: sorting brings equal windows together. The place
    takes as many low bits as the list needs, so the hash keeps 64 less those, or
    bits_kept if that is less. Neighbours of equal hash are compared word by word; where
    two differ, which only a collision makes, the list is sorted by the words instead."""

    def counted(w: Column, packed: Column, bits: Column) -> Column:
        window = lambda v: F.call_function("shiftrightunsigned", v, bits)
        place = lambda v: v.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1)
        word = lambda v, i: F.get(w, place(v).cast("int") + i)
        differ = lambda a, b: (window(a) == window(b)) & ~((word(a, 0) == word(b, 0)) & (word(a, 1) == word(b, 1)) & (word(a, 2) == word(b, 2)))
        collided = lambda r: F.size(F.filter(r, lambda v, k: differ(v, F.get(r, k + 1)))) > 0
        repeated = F.filter(packed, lambda v, k: (window(v) == window(F.get(packed, k + 1))) | (window(v) == window(F.get(packed, k - 1))))
        return _let(repeated, lambda r: F.when(collided(r), _sorted_windows(w)).otherwise(_cover(F.transform(r, place))))

    def windows(w: Column, bits: Column) -> Column:
        def packed(k: Column) -> Column:
            hashed = F.xxhash64(F.get(w, k), F.get(w, k + 1), F.get(w, k + 2))
            hashed = hashed if bits_kept >= 64 else hashed.bitwiseAND((1 << bits_kept) - 1)
            return F.call_function("shiftleft", hashed, bits).bitwiseOR(k.cast("bigint"))

        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), packed))

    bits_of = lambda w: F.length(F.bin(F.size(w).cast("bigint")))
    whole = lambda w: _let(bits_of(w), lambda bits: _let(windows(w, bits), lambda packed: counted(w, packed, bits)))
    return _let(words, lambda w: F.when(F.size(w) >= 4, whole(w)).otherwise(F.lit(0).cast("bigint")))


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda v: F.btrim(v, F.lit(BLANKS)) != "")


def normalised(line: Column) -> Column:
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(BLANKS)), SPACE + "+", " "))


def base(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, the statistics of whole texts, base_failed, and further columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # split once: the optimizer keeps this projection, since its arrays are used several times
    split = docs.select("doc_id", text.alias("__text"), words_of(text).alias("__words"), lines_of(text).alias("__lines"), *(c.alias(f"__more{k}") for k, c in enumerate(more)))
    counted = split.select(
        "doc_id",
        F.size("__words").cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("__words")).alias("n_repeat_words"),
        *(f"__more{k}" for k in range(len(more))),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, content, host, place, line key, words) of each line with a word."""
    text, host = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit(""))
    rows = docs.select("doc_id", _content(text).alias("content"), host.alias("host"), F.posexplode(lines_of(text)).alias("place", "line"))
    keyed = F.xxhash64("host", normalised(F.col("line")))
    return rows.select("doc_id", "content", "host", "place", keyed.alias("line"), F.size(words_of(F.col("line"))).cast("bigint").alias("words"))


def _content(text: Column) -> Column:
    return F.xxhash64(text)


def removals(docs: DataFrame, line_docs: int = LINE_DOCS, share: int = LINE_SHARE) -> DataFrame:
    """A stored table (doc_id, content, removed, keys): of each document with common
    lines, the words in them and their keys. Documents repeated as whole rows are
    one row here. All counting is by partial aggregates; nothing gathers a host."""
    text, host = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit(""))
    hosts = docs.select(host.alias("host"), _content(text).alias("content")).distinct().groupBy("host").agg(F.count("*").alias("docs"))
    lines = _lines(docs)
    # first by rows, an upper bound that few lines reach; then those lines by distinct documents
    often = store.table(lines.groupBy("line").agg(F.count("*").alias("n"), F.first("host").alias("host")).where(F.col("n") > line_docs).select("line", "host"), "often")
    hosts = store.table(hosts, "hosts")
    found = store.table(lines.drop("host").join(store.small(often), "line"), "found")
    counted = found.select("line", "host", "content").distinct().groupBy("line", "host").agg(F.count("*").alias("n"))
    common = counted.where(F.col("n") > line_docs).join(store.small(hosts), "host").where(F.col("n") * share > F.col("docs")).select("line")
    gone = found.join(store.small(store.table(common, "common")), "line").select("doc_id", "content", "place", "line", "words").distinct()
    return store.table(gone.groupBy("doc_id", "content").agg(F.sum("words").alias("removed"), F.collect_set("line").alias("keys")), "removals")


def judge(docs: DataFrame, line_docs: int = LINE_DOCS, share: int = LINE_SHARE) -> DataFrame:
    """Per row of docs (doc_id, text, source): the statistics, base_failed, removed (the
    words in common lines) and kept.

    A null text has no words, so it fails; a null source is a source of its own; rows
    with a null id are judged as any other, and repeated rows alike."""
    gone = removals(docs, line_docs, share).select(F.col("doc_id").alias("__id"), F.col("content").alias("__content"), "removed")
    rows = base(docs, _content(F.coalesce(F.col("text"), F.lit("")))).withColumnRenamed("__more0", "__own")
    joined = rows.join(store.small(gone), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__content")), "left")
    lost = F.coalesce(F.col("removed"), F.lit(0).cast("bigint"))
    kept = ~F.col("base_failed") & (2 * lost <= F.col("n_words"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), lost.alias("removed"))


def keep(docs: DataFrame, line_docs: int = LINE_DOCS, share: int = LINE_SHARE) -> DataFrame:
    """The documents that judge() keeps, without their common lines, in docs' columns.
    n_chars, where docs has it, is counted anew for a text that lost lines."""
    names = docs.columns
    gone = removals(docs, line_docs, share).select(F.col("doc_id").alias("__id"), F.col("content").alias("__content"), F.col("removed").alias("__removed"), F.col("keys").alias("__keys"))
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.withColumns({"__own": _content(text), "__words": words_of(text)})
    marked = marked.withColumns({"__n": F.size("__words").cast("bigint"), "__repeat": repeat_words(F.col("__words"))}).drop("__words")
    marked = marked.where((F.col("__n") >= LEAST_WORDS) & (100 * F.col("__repeat") <= REPEAT_PERCENT * F.col("__n")))
    joined = marked.join(store.small(gone, size=8 * F.size("__keys")), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__content")), "left")
    joined = joined.where(2 * F.coalesce("__removed", F.lit(0)) <= F.col("__n"))
    host = F.coalesce(F.col("source").cast("string"), F.lit(""))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda v: ~F.coalesce(F.array_contains(F.col("__keys"), F.xxhash64(host, normalised(v))), F.lit(False))), "\n")
    cut = F.when(F.col("__keys").isNotNull(), left).otherwise(F.col("text"))
    joined = joined.withColumn("__text", cut)
    new = {"text": F.col("__text")} | ({"n_chars": F.when(F.col("__keys").isNotNull(), F.length("__text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if "n_chars" in names else {})
    return joined.select(*(new.get(c, F.col(c)).alias(c) for c in names))


#: The same rows by DuckDB. One line is one string here, where the operator takes its hash.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
w AS (SELECT doc_id, text, host, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
tri AS (SELECT doc_id, k, (words[k], words[k + 1], words[k + 2]) AS t
        FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS k FROM w WHERE len(words) > 2)),
rep AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, t) AS n FROM tri) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS p FROM rep) GROUP BY doc_id),
ln AS (SELECT doc_id, text, host, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
              lower(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
       FROM (SELECT doc_id, text, host, unnest(lines) AS line FROM w)),
hosts AS (SELECT host, count(DISTINCT text) AS docs FROM d GROUP BY host),
common AS (SELECT l.host, l.line FROM ln l JOIN hosts h ON h.host = l.host GROUP BY l.host, l.line, h.docs
           HAVING count(DISTINCT l.text) > 20 AND count(DISTINCT l.text) * 50 > h.docs),
gone AS (SELECT doc_id, sum(n) AS removed FROM ln JOIN common USING (host, line) GROUP BY doc_id),
b AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(gone.removed, 0) AS BIGINT) AS removed
      FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id LEFT JOIN gone ON gone.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * removed <= n_words AS kept, removed
FROM b
"""
