"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Names, numbers and units become typed placeholders, the rest lower-case words. Every run of ``window``
tokens is hashed; the hashes of the benchmark's windows meet those of all documents in a join. A
document holds a question if it has at least ``least_coverage`` of the question's distinct windows and
if, along the alignment with most windows or any other that has enough of them by itself, the slots of
its windows are consistent: a value of the question always stands for the same value in the document
and the other way round. So a question with other names
and numbers is caught, while a text that only shares the template's shape is not.

Beside these, runs of ``window`` lower-case words without placeholders are hashed and joined alike. A document
with at least ``least_coverage`` of them holds a copy of the question, whatever its case and however
many names and numbers it has. If the slots along the placeholders' alignment contradict the question,
only a copy of all its windows counts. Such pairs have counts of these windows, and no slots.

Name: capitalised words after a small letter, digit, comma, colon or semicolon. Number: digits with
separators, sign or per cent. Unit: a word of ``UNITS`` after a number. A window needs literal words in
half of its places. Questions shorter than a window are matched by windows of their own length.

The windows of documents are filtered by a broadcast of the benchmark's distinct hashes if there are at
most ``BROADCAST_WINDOWS`` (a few bytes each), beyond that by a shuffled join; what follows handles hits only.

Cases: null and empty texts have no window and hit nothing; so have questions without words. A null
doc_id or item_id takes no part. Rows with the same doc_id count as one document, rows with the same
item_id as one question. Extra columns are ignored (``drop_contaminated`` keeps them). Texts are used
whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeline.llm.common import cut

WINDOW, LEAST_COVERAGE = 8, 0.5
BROADCAST_WINDOWS, BROADCAST_IDS = 500_000, 500_000

#: Units of measure, time and money that may follow a number.
UNITS = (
    "kg g mg t lb lbs oz km m cm mm mi ft in l ml gal h hr hrs min s sec ms hours hour minutes minute seconds second "
    "days day weeks week months month years year miles mile meters metres feet inches grams kilograms liters litres "
    "dollars dollar cents euros euro pounds pound usd eur percent degrees"
).split()

# A repeated group without "+" behind its star is matched by recursion, as deep as the text is long.
NAME = r"([\p{Ll}\p{Nd},;:] )(\p{Lu}[\p{L}\p{M}]*(?: \p{Lu}[\p{L}\p{M}]*)*+)"
NUMBER = r"(^|[^\p{L}\p{Nd}\x01])([+-]?\p{Nd}+(?:[.,:/]\p{Nd}+)*+%?)"
UNIT = r"(\x02) ?(" + "|".join(UNITS) + r")([^\p{L}]|$)"
WORD = r"[\p{L}\p{M}\p{Nd}]+"
TOKEN = r"\x01[^\x02]*\x02|" + WORD
#: Kinds of windows: with placeholders, and of plain words.
SLOTS, PLAIN = 0, 1


def tokens(text: Column) -> Column:
    """Words and slots; a slot is marked by \\x01, its type and value, and \\x02."""
    marked = text.contains("\x01") | text.contains("\x02")
    plain = F.when(text.isNull(), "").when(marked, F.translate(text, "\x01\x02", "  ")).otherwise(text)
    named = F.regexp_replace(plain, NAME, "$1\x01n$2\x02")
    counted = F.regexp_replace(named, NUMBER, "$1\x01d$2\x02")
    measured = F.regexp_replace(counted, UNIT, "$1\x01u$2\x02$3")
    return F.regexp_extract_all(measured, F.lit(TOKEN), F.lit(0))


def canonical(token: Column) -> Column:
    """The word in lower case, or the slot's type."""
    return F.when(token.startswith("\x01"), F.substring(token, 1, 2)).otherwise(F.lower(token))


def plain_words(text: Column) -> Column:
    """Words in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _word_hashes(text: Column, kind: int) -> Column:
    if kind == PLAIN:
        return F.transform(plain_words(text), lambda w: F.xxhash64(w))
    return F.transform(tokens(text), lambda w: F.xxhash64(canonical(w)))


def _windows(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with column ``words`` (hashes): at (from 0), hash of every window of ``size`` words."""
    last = F.size("words") - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    parts = [F.get("words", F.col("at") + i) for i in range(size)]
    return rows.withColumn("at", F.explode(starts)).withColumn("hash", F.xxhash64(*parts)).drop("words")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, kind: int = SLOTS) -> DataFrame:
    """item_id, size, hash, at (first place): the distinct windows of each question.

    Those with placeholders need enough literal words.
    """
    raw = tokens(F.col("text")) if kind == SLOTS else plain_words(F.col("text"))
    rows = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), raw.alias("raw"))
    rows = rows.withColumn("size", F.least(F.size("raw"), F.lit(window))).where("size > 0")
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("raw") - F.col("size"))))
    part = F.slice("raw", F.col("at") + 1, F.col("size"))
    if kind == SLOTS:
        rows = rows.where(F.size(F.filter(part, lambda w: ~w.startswith("\x01"))) * 2 >= F.col("size"))
    hashes = F.transform(part, lambda w: F.xxhash64(canonical(w) if kind == SLOTS else w))
    # The hash of an array is that of its elements as columns, so documents needn't cut arrays.
    return rows.groupBy("item_id", "size", F.xxhash64(hashes).alias("hash")).agg(F.min("at").alias("at"))


def _hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, item_id, kind, size, hash, item_at, shift: document windows that are a question's."""
    # At most ``window`` sizes of each kind.
    sizes = [(r["kind"], r["size"]) for r in windows.select("kind", "size").distinct().orderBy("kind", "size").collect()]
    known = cut(windows.select("kind", "size", "hash").distinct())
    broadcast = known.count() <= BROADCAST_WINDOWS
    hits = None
    for kind, size in sizes or [(SLOTS, WINDOW)]:
        words = docs.select("doc_id", _word_hashes(F.col("text"), kind).alias("words"))
        own = known.where((F.col("kind") == kind) & (F.col("size") == size)).select("hash")
        seen = _windows(words, size).join(F.broadcast(own) if broadcast else own, "hash", "left_semi")
        seen = seen.withColumn("size", F.lit(size)).withColumn("kind", F.lit(kind))
        hits = seen if hits is None else hits.unionByName(seen)
    found = hits.join(windows.withColumnRenamed("at", "item_at"), ["kind", "size", "hash"])
    return found.select("doc_id", "item_id", "kind", "size", "hash", "item_at", (F.col("at") - F.col("item_at")).alias("shift"))


def _covered(hits: DataFrame, windows: DataFrame, least_coverage: float) -> DataFrame:
    """doc_id, item_id, n_matched, n_windows of the pairs with enough of a question's windows."""
    totals = windows.groupBy("item_id").agg(F.count("*").alias("n_windows"))
    matched = hits.groupBy("doc_id", "item_id").agg(F.countDistinct("size", "hash").alias("n_matched"))
    return matched.join(totals, "item_id").where(F.col("n_matched") >= F.col("n_windows") * least_coverage)


def _pairs_of(doc: Column, item: Column, shift: Column, places: Column) -> Column:
    """(value in the question, value in the document) of slots that lie upon each other at ``places`` of the question."""
    other = lambda at: F.get(doc, at + shift)
    both = F.transform(places, lambda at: F.struct(F.get(item, at).alias("q"), other(at).alias("d")))
    slots = F.filter(both, lambda p: p["q"].startswith("\x01") & (F.substring(p["q"], 1, 2) == F.substring(p["d"], 1, 2)))
    return F.array_distinct(slots)


def _consistent(slots: Column) -> Column:
    values = lambda side: F.size(F.array_distinct(F.transform(slots, lambda p: p[side])))
    return (values("q") == F.size(slots)) & (values("d") == F.size(slots))


def _alignments(hits: DataFrame, matched: DataFrame, least_coverage: float) -> DataFrame:
    """``matched`` with column ``shifts``: the alignment with most windows, then others that reach the coverage.

    Each has the first place and size of its windows. One row gathers the hits of one document.
    """
    spots = F.collect_set(F.struct("item_at", "size")).alias("spots")
    shifts = hits.groupBy("doc_id", "item_id", "shift").agg((-F.count("*")).alias("order"), spots)
    shifts = shifts.join(matched.select("doc_id", "item_id"), ["doc_id", "item_id"], "left_semi")
    shifts = shifts.groupBy("doc_id", "item_id").agg(F.array_sort(F.collect_list(F.struct("order", "shift", "spots"))).alias("all"))
    least = F.col("n_windows") * least_coverage
    own = F.filter("all", lambda c, i: (i == 0) | (F.size(c["spots"]) >= least))
    return matched.join(shifts, ["doc_id", "item_id"]).withColumn("shifts", own).drop("all")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    least_coverage: float = LEAST_COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, n_matched, n_windows, n_slots, n_changed: questions found in documents.

    ``n_slots`` counts distinct pairs of slot values, ``n_changed`` those whose values differ.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    both = [benchmark_windows(benchmark, window, kind).withColumn("kind", F.lit(kind)) for kind in (SLOTS, PLAIN)]
    windows = cut(both[0].unionByName(both[1]))
    hits = cut(_hits(docs, windows))
    copies = cut(_covered(hits.where(F.col("kind") == PLAIN), windows.where(F.col("kind") == PLAIN), least_coverage))
    windows, hits = windows.where(F.col("kind") == SLOTS), hits.where(F.col("kind") == SLOTS)
    matched = cut(_covered(hits, windows, least_coverage))
    candidates = pairs = cut(_alignments(hits, matched, least_coverage))
    if pairs.count() <= BROADCAST_IDS:
        pairs = F.broadcast(pairs)
    questions = benchmark.where("item_id is not null").select(
        F.col("item_id").cast("long").alias("item_id"), tokens(F.col("text")).alias("question")
    )
    # Cut, so that tokens are columns below and not expressions that run for each element.
    found = cut(docs.join(pairs, "doc_id").withColumn("words", tokens(F.col("text"))).drop("text").join(questions, "item_id"))
    covered = lambda spots: F.array_distinct(
        F.flatten(F.transform(spots, lambda w: F.sequence(w["item_at"], w["item_at"] + w["size"] - 1)))
    )
    slots = lambda shift, places: _pairs_of(F.col("words"), F.col("question"), shift, places)
    tried = F.transform("shifts", lambda c: F.struct(c["shift"].alias("shift"), slots(c["shift"], covered(c["spots"])).alias("slots")))
    found = cut(found.withColumn("tried", tried).drop("shifts"))
    found = found.withColumn("best", F.get(F.filter("tried", lambda c: _consistent(c["slots"])), F.lit(0))).where("best is not null")
    # Slots beside the matched windows are counted if they agree too.
    places = F.sequence(F.lit(0), F.size("question") - 1)
    found = cut(found.withColumn("whole", slots(F.col("best.shift"), places)).drop("words", "question", "tried"))
    found = found.withColumn("slots", F.when(_consistent(F.col("whole")), F.col("whole")).otherwise(F.col("best.slots")))
    changed = F.size(F.filter("slots", lambda p: p["q"] != p["d"]))
    found = found.withColumn("n_slots", F.size("slots").cast("long")).withColumn("n_changed", changed.cast("long"))
    counts = ("n_matched", "n_windows", "n_slots", "n_changed")
    found = cut(found.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in counts)))
    denied = candidates.select("doc_id", "item_id", F.lit(True).alias("denied"))
    copies = copies.join(found, ["doc_id", "item_id"], "left_anti").join(denied, ["doc_id", "item_id"], "left")
    copies = copies.where("denied is null or n_matched = n_windows")
    none = F.lit(0).cast("long")
    return found.unionByName(copies.select("doc_id", "item_id", "n_matched", "n_windows", none.alias("n_slots"), none.alias("n_changed")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no question of ``benchmark``; all columns stay, null ids too."""
    bad = cut(contaminated(docs, benchmark).select(F.col("doc_id").alias("contaminated_id")).distinct())
    found = bad.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(bad) if found else bad, docs["doc_id"].cast("long") == bad["contaminated_id"], "left_anti")


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''").replace("*+", "*") + "'"  # DuckDB's matcher needs no possessive star


def _sql_tokens(text: str) -> str:
    plain = f"translate(coalesce({text}, ''), chr(1) || chr(2), '  ')"
    named = rf"regexp_replace({plain}, {_quoted(NAME)}, '\1' || chr(1) || 'n\2' || chr(2), 'g')"
    counted = rf"regexp_replace({named}, {_quoted(NUMBER)}, '\1' || chr(1) || 'd\2' || chr(2), 'g')"
    measured = rf"regexp_replace({counted}, {_quoted(UNIT)}, '\1' || chr(1) || 'u\2' || chr(2) || '\3', 'g')"
    return f"regexp_extract_all({measured}, {_quoted(TOKEN)})"


#: The windows with placeholders in DuckDB, as text, along the best alignment.
SQL = f"""
WITH d AS (SELECT doc_id, {_sql_tokens('text')} AS raw FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id, {_sql_tokens('text')} AS raw FROM benchmark WHERE item_id IS NOT NULL),
dw AS (SELECT doc_id, list_transform(raw, lambda x: CASE WHEN x[1] = chr(1) THEN x[1:2] ELSE lower(x) END) AS words FROM d),
bw AS (SELECT item_id, least(len(raw), {WINDOW}) AS size,
  list_transform(raw, lambda x: CASE WHEN x[1] = chr(1) THEN x[1:2] ELSE lower(x) END) AS words FROM b),
bp AS (SELECT item_id, size, words, unnest(range(1, len(words) - size + 2)) AS pos FROM bw WHERE size > 0),
bk AS (SELECT item_id, size, pos, words[pos:pos + size - 1] AS part FROM bp),
bx AS (SELECT item_id, size, array_to_string(part, ' ') AS k, min(pos) AS pos FROM bk
  WHERE 2 * len(list_filter(part, lambda x: x[1] <> chr(1))) >= size GROUP BY ALL),
dp AS (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos
  FROM dw, (SELECT DISTINCT size FROM bx) WHERE len(words) >= size),
dx AS (SELECT doc_id, size, pos, array_to_string(words[pos:pos + size - 1], ' ') AS k FROM dp),
hits AS (SELECT doc_id, item_id, k, dx.pos - bx.pos AS shift FROM dx JOIN bx USING (size, k)),
matched AS (SELECT doc_id, item_id, count(DISTINCT k) AS n_matched FROM hits GROUP BY ALL),
totals AS (SELECT item_id, count(*) AS n_windows FROM bx GROUP BY ALL),
runs AS (SELECT doc_id, item_id, shift, count(*) AS n FROM hits GROUP BY ALL),
best AS (SELECT doc_id, item_id, shift FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n DESC, shift) = 1),
pairs AS (SELECT doc_id, item_id, n_matched, n_windows, shift FROM matched JOIN totals USING (item_id) JOIN best USING (doc_id, item_id)
  WHERE n_matched >= n_windows * {LEAST_COVERAGE}),
slots AS (SELECT doc_id, item_id, n_matched, n_windows, list_distinct(list_filter(
    list_transform(range(1, len(b.raw) + 1), lambda i: {{'q': b.raw[i], 'd': CASE WHEN i + shift >= 1 THEN d.raw[i + shift] END}}),
    lambda p: p.q[1] = chr(1) AND p.q[1:2] = p.d[1:2])) AS s
  FROM pairs JOIN d USING (doc_id) JOIN b USING (item_id))
SELECT doc_id, item_id, max(n_matched)::BIGINT AS n_matched, max(n_windows)::BIGINT AS n_windows,
  max(len(s))::BIGINT AS n_slots, max(len(list_filter(s, lambda p: p.q <> p.d)))::BIGINT AS n_changed
FROM slots
WHERE len(list_distinct(list_transform(s, lambda p: p.q))) = len(s) AND len(list_distinct(list_transform(s, lambda p: p.d))) = len(s)
GROUP BY ALL
"""
