"""Removal of lines that recur across documents, by a tree of line templates.

A line goes down a tree of fixed depth: its number of tokens, its leading tokens
(numbers are fields), and the rest of it in blocks of neighbouring tokens. Lines that
are equal are one entry of a leaf. A leaf generalises: entries that agree in all but
one block, or in all but their numbers, form a template with a field there, but only
if the leaf shows it to be one, by entries from several documents, and the constant
part covers most of the line.

An entry in two documents or more stays in the first. Of the entries that chose a
template, those of its first document stay. So every line that goes has a mate that
stays: an equal line, or one of its template.

Built-in column expressions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import delete_folder, new_run_folder

#: Leading tokens that are levels of the tree.
DEPTH = 2
#: Blocks of the tokens after them, of which one may be a field.
BLOCKS = 16
#: Documents that a field needs, each with an entry of its own.
FIELD_DOCS = 5
#: Tokens that a line needs for a field of words, which then is an eighth of it or less.
FIELD_TOKENS = 8
#: Tokens that a line needs for each number in it, for its numbers to be fields.
NUMBER_TOKENS = 4

_BLOCKS = [f"b{i}" for i in range(BLOCKS)]
_ENTRY = ["exact", "check"]
_KEY = ["variant", "key", "key_check"]
#: Halves of a line that must agree, and the whole of it.
_FIRST, _SECOND, _WHOLE = range(3)


def _entries(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """A row for each line that is not blank: its document, place, and path in the tree."""
    body = F.coalesce(F.col(text), F.lit(""))
    plain = F.regexp_replace(body, "[ \\x09\\x0B-\\x0D]+", " ")
    doc = F.struct(F.col(id_col).alias("id"), F.xxhash64(body).alias("text_hash")).alias("doc")
    lines = docs.select(doc, F.posexplode(F.split(plain, "\n", -1)).alias("pos", "raw"))
    lines = lines.select("doc", "pos", F.trim("raw").alias("line")).filter("line != ''")
    masked = lines.withColumn("masked", F.regexp_replace("line", "[0-9]+", "0"))
    masked = masked.withColumn("words", F.split("masked", " ", -1))
    tokens = F.size("words")
    lead = F.xxhash64(*(F.get("words", i) for i in range(DEPTH)))
    numbers = F.length("masked") - F.length(F.replace("masked", F.lit("0"), F.lit("")))

    def block(i: int) -> Column:
        start, end = _ends(tokens, i)
        return F.hash(F.slice("words", start + DEPTH + 1, end - start)).alias(_BLOCKS[i])

    return masked.select(
        "doc",
        "pos",
        # 96 bits of hash stand for a line
        F.xxhash64("line").alias("exact"),
        F.hash("line").alias("check"),
        tokens.alias("tokens"),
        ((numbers > 0) & (numbers * NUMBER_TOKENS <= tokens)).alias("numbered"),
        lead.alias("lead"),
        *(block(i) for i in range(BLOCKS)),
    )


def _ends(tokens: Column, i: int) -> tuple[Column, Column]:
    rest = F.greatest(tokens - DEPTH, F.lit(0))
    return tuple(F.floor(rest * j / BLOCKS).cast("int") for j in (i, i + 1))


def _side(side: int) -> Column:
    """What entries of a leaf agree in if their field is elsewhere."""
    part = {_FIRST: _BLOCKS[: BLOCKS // 2], _SECOND: _BLOCKS[BLOCKS // 2 :], _WHOLE: _BLOCKS}[side]
    return F.xxhash64("tokens", "lead", *part)


def _eligible(side: int) -> Column:
    return F.col("numbered") if side == _WHOLE else F.col("tokens") >= FIELD_TOKENS


def _template(variant: int) -> Column:
    """The line without one block (none: -1), if that block has tokens."""
    rest = ["tokens", "lead", *(c for i, c in enumerate(_BLOCKS) if i != variant)]
    made = F.struct(
        F.lit(variant).alias("variant"), F.xxhash64(*rest).alias("key"), F.hash(*rest).alias("key_check")
    )
    if variant < 0:
        return made
    start, end = _ends(F.col("tokens"), variant)
    return F.when(end > start, made)


def _candidates(entries: DataFrame, shared: DataFrame) -> DataFrame:
    """Entries and their templates, of lines that share a side with other ones."""
    variants = {_FIRST: range(BLOCKS // 2, BLOCKS), _SECOND: range(BLOCKS // 2), _WHOLE: [-1]}
    found = None
    for side, own in variants.items():
        akin = shared.filter(F.col("side") == side).select("agreed")
        lines = entries.filter(_eligible(side)).withColumn("agreed", _side(side)).join(akin, "agreed", "left_semi")
        templates = F.explode(F.array_compact(F.array(*(_template(v) for v in own))))
        part = lines.select(*_ENTRY, "doc", templates.alias("t")).select(*_ENTRY, "doc", "t.*")
        found = part if found is None else found.unionByName(part)
    return found.groupBy(*_ENTRY, *_KEY).agg(F.min("doc").alias("first"))


def recurring_lines(docs: DataFrame, folder: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc`` (id and hash of its text) and ``dropped``, the numbers of its lines that go.

    Works in ``folder``, which the rows are read from.
    """
    spark = docs.sparkSession

    def kept(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    entries = kept(_entries(docs, id_col, text), "entries")
    first, last = F.min("doc").alias("first"), F.max("doc").alias("last")
    same = entries.groupBy(*_ENTRY).agg(first, last).filter(~F.col("first").eqNullSafe(F.col("last")))
    same = kept(same.select(*_ENTRY, "first"), "same")
    sides = F.array(
        *(F.when(_eligible(s), F.struct(F.lit(s).alias("side"), _side(s).alias("agreed"))) for s in range(3))
    )
    met = entries.select("exact", F.explode(F.array_compact(sides)).alias("s")).groupBy("s.side", "s.agreed")
    several = (F.col("rows") >= FIELD_DOCS) & (F.col("low") != F.col("high"))
    counted = met.agg(F.count("*").alias("rows"), F.min("exact").alias("low"), F.max("exact").alias("high"))
    shared = kept(counted.filter(several).select("side", "agreed"), "shared")
    candidates = kept(_candidates(entries, shared), "candidates")
    docs_of = candidates.select(*_KEY, "first").distinct().groupBy(*_KEY).agg(F.count("*").alias("docs"))
    templates = kept(docs_of.filter(F.col("docs") >= FIELD_DOCS), "templates")
    # fewest fields first, then the best attested, then the leftmost
    order = F.struct((F.col("variant") >= 0).alias("field"), (-F.col("docs")).alias("docs"), *_KEY)
    chosen = candidates.join(templates, _KEY).groupBy(*_ENTRY).agg(F.min(order).alias("t"), F.min("first").alias("first"))
    chosen = kept(chosen.select(*_ENTRY, "first", *(F.col(f"t.{c}") for c in _KEY)), "chosen")
    stays = kept(chosen.groupBy(*_KEY).agg(F.min("first").alias("stay")), "stays")
    general = chosen.join(stays, _KEY).select(*_ENTRY, F.col("stay").alias("first"))
    stay = kept(general.unionByName(same.join(general, _ENTRY, "left_anti")), "stay")
    for name in ("same", "shared", "candidates", "templates", "chosen", "stays"):
        delete_folder(spark, f"{folder}/{name}")
    return (
        entries.select(*_ENTRY, "doc", "pos")
        .join(stay, _ENTRY)
        .filter(~F.col("doc").eqNullSafe(F.col("first")))
        .groupBy("doc")
        .agg(F.collect_set("pos").alias("dropped"))
    )


def _cleaned(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, list[str]]:
    """The documents with columns by position, and ``lines`` and ``kept`` (numbers) besides; those names.

    Blank lines always stay. Rows with the same id and text are one document and lose
    the same lines. A null text is one blank line; a null id comes before all others.
    """
    folder = new_run_folder(docs.sparkSession, "lines")
    dropped = recurring_lines(docs, folder, id_col, text)
    names = [f"c{i}" for i in range(len(docs.columns))]
    own, body = (F.col(names[docs.columns.index(c)]) for c in (id_col, text))
    body = F.coalesce(body, F.lit(""))
    mine = own.eqNullSafe(F.col("doc.id")) & (F.xxhash64(body) == F.col("doc.text_hash"))
    lines = F.split(body, "\n", -1)
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.array_except(every, F.coalesce("dropped", F.array().cast("array<int>")))
    joined = docs.toDF(*names).join(dropped, mine, "left")
    return joined.select(*names, lines.alias("lines"), kept.alias("kept")), names


def _kept_text() -> Column:
    return F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")


def line_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_lines``, ``n_kept`` and ``text``, what is left of it (null: empty), of each document."""
    found, names = _cleaned(docs.select(id_col, text), id_col, text)
    sizes = (F.size(c).cast("long") for c in ("lines", "kept"))
    made = zip(sizes, ("n_lines", "n_kept"))
    return found.select(F.col(names[0]).alias("id"), *(c.alias(n) for c, n in made), _kept_text().alias("text"))


def without_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the lines that recur. No row is dropped; null texts stay null."""
    found, names = _cleaned(docs, id_col, text)
    at = docs.columns.index(text)
    left = F.when(F.col(names[at]).isNotNull(), _kept_text())
    return found.select(*(left if i == at else F.col(c) for i, c in enumerate(names))).toDF(*docs.columns)


# The same in SQL; entries and templates are strings here.
SQL = f"""
WITH doc AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines,
         string_split(regexp_replace(coalesce(text, ''), '[ \\x09\\x0B-\\x0D]+', ' ', 'g'), chr(10)) AS plain
  FROM documents
), own AS (
  SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM doc
), entry AS (
  SELECT doc_id, pos, trim(line, ' ') AS exact
  FROM (SELECT doc_id, unnest(range(len(plain))) AS pos, unnest(plain) AS line FROM doc)
  WHERE trim(line, ' ') <> ''
), same AS (
  SELECT exact, string_split(regexp_replace(exact, '[0-9]+', '0', 'g'), ' ') AS words,
         min(doc_id) AS first_doc, count(DISTINCT doc_id) AS docs
  FROM entry GROUP BY exact
), counted AS (
  SELECT *, len(words) AS tokens, greatest(len(words) - {DEPTH}, 0) AS rest,
         length(array_to_string(words, ' ')) - length(replace(array_to_string(words, ' '), '0', '')) AS numbers
  FROM same
), candidate AS (
  SELECT exact, first_doc, tokens, -1 AS variant, array_to_string(words, ' ') AS shape
  FROM counted WHERE numbers > 0 AND numbers * {NUMBER_TOKENS} <= tokens
  UNION ALL
  SELECT exact, first_doc, tokens, v,
         array_to_string(words[: {DEPTH} + rest * v // {BLOCKS}] || ['*']
                         || words[{DEPTH} + rest * (v + 1) // {BLOCKS} + 1 :], ' ')
  FROM counted, (SELECT unnest(range({BLOCKS})) AS v)
  WHERE tokens >= {FIELD_TOKENS} AND rest * (v + 1) // {BLOCKS} > rest * v // {BLOCKS}
), template AS (
  SELECT tokens, variant, shape, count(DISTINCT first_doc) AS docs
  FROM candidate GROUP BY tokens, variant, shape HAVING count(DISTINCT first_doc) >= {FIELD_DOCS}
), chosen AS (
  SELECT exact, first_doc, tokens, variant, shape
  FROM candidate JOIN template USING (tokens, variant, shape)
  QUALIFY row_number() OVER (PARTITION BY exact ORDER BY variant >= 0, docs DESC, variant) = 1
), general AS (
  SELECT exact, min(first_doc) OVER (PARTITION BY tokens, variant, shape) AS stay FROM chosen
), stay AS (
  SELECT exact, coalesce(g.stay, s.first_doc) AS stay FROM same s LEFT JOIN general g USING (exact)
), dropped AS (
  SELECT doc_id, pos FROM entry JOIN stay USING (exact) WHERE doc_id <> stay
)
SELECT o.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE d.pos IS NULL) AS n_kept,
       sha256(coalesce(string_agg(o.line, chr(10) ORDER BY o.pos)
                       FILTER (WHERE d.pos IS NULL), '')) AS text_sha256
FROM own o LEFT JOIN dropped d ON o.doc_id = d.doc_id AND o.pos = d.pos
GROUP BY o.doc_id
"""
