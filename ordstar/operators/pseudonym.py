"""Pseudonymisation: names → stable fake names, identifiers → sequential tokens.

Both keep one mapping (a namespace shared by all listed columns) that carries
over between runs. The first occurrence of a value in (column, row) order
decides its category (names) or type and number (identifiers); a run is one
such order whatever its size, so a batch and a stream with one arrival agree. Here:

1. rows are numbered in their order where a number depends on it (identifiers); one
   explode turns the listed columns into ``(value, column, row number)``
   occurrences, and ``min`` of column and row in one long per value is the first
   occurrence: a hash aggregate whose partial step combines a hot value's
   rows before the shuffle. The result is written once: the values asked for;
2. values already in the saved mapping drop out by anti-join;
3. identifiers are numbered per type with the grouped dense numbering,
   continuing after the saved counter of each type; names get a fake from a
   salted SHA-256 pick, and values whose fake collides get a rank suffix, so
   the mapping is injective and reproducible;
   A saved mapping is a DataFrame, or a state of keyed storage (``sources.keyed_store``)
   that answers by key: then only the values at hand move, not the mapping;
4. the mapping is written once (it is the saved state) and looked up, column by column,
   when the masked rows are asked for: a broadcast lookup where the whole mapping or the
   column's own entries are within the broadcast threshold, otherwise a hash join
   on the column. Blank values never look anything up. Inside ``parts.in_place`` the rows
   stay for such a column, too: its distinct values move, and their masked texts.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordstar.functions.text import capitalize, col, cols, is_blank, last_number, py_strip, zfill
from ordstar.operators import parts
from ordstar.operators.numbering import dense_number
from ordstar.session import broadcast_limit, freed_shuffles, materialize, materialize_only, size_in_bytes
from ordstar.specs import ID_BLANK_TOKENS, ID_PREFIX, ID_TYPE_BY_NAME, ID_TYPE_BY_PART, ID_TYPE_DEFAULT

NAME_MAP_COLUMNS = ("original", "anonymized", "category")
ID_MAP_COLUMNS = ("original", "fake", "id_type")

# Category of a name column, decided on the column *name* (first rule that
# matches wins). The substrings and their order.
NAME_RULES = (
    (("buyer", "trader"), "company"),
    (("manufacturer", "sellingManufacturerFacilityName"), "manufacturing"),
    (("point_of_contact",), "person"),
)
DEFAULT_NAME_CATEGORY = "word"


def name_category(column: str) -> str:
    for needles, category in NAME_RULES:
        if any(n in column for n in needles):
            return category
    return DEFAULT_NAME_CATEGORY


def id_type(column: str) -> str:
    """Identifier type of a column, by the rule tables."""
    parts = (kind for part, kind in ID_TYPE_BY_PART if part in column.lower())
    return ID_TYPE_BY_NAME.get(column) or next(parts, ID_TYPE_DEFAULT)


# Word lists for generated names (our own; any disjoint lists work). Company
# = surname + surname + suffix (43,200 bases), person = first name + middle
# initial + surname (62,400 bases), word = one noun. Many bases keep the
# groups that resolve collisions (one window partition per base) small.
SURNAMES = (
    "Abbott", "Barrow", "Calder", "Dalton", "Ellery", "Fenwick", "Garrick", "Hadley", "Ingram", "Jarvis",
    "Kendall", "Langley", "Marlow", "Norcross", "Oakley", "Pembroke", "Quinlan", "Radcliffe", "Sutton", "Thorne",
    "Upton", "Vance", "Whitlock", "Yardley", "Ashby", "Brandt", "Colby", "Drummond", "Easton", "Fairfax",
    "Granger", "Holloway", "Irwin", "Kessler", "Lockwood", "Merritt", "Nash", "Osborne", "Prescott", "Rowan",
    "Sinclair", "Tate", "Underhill", "Vaughn", "Wexford", "Alder", "Bramwell", "Carver", "Denholm", "Everly",
    "Foley", "Gilmore", "Hartley", "Keane", "Lowell", "Mercer", "Nolan", "Ogden", "Pryor", "Ridley",
)
COMPANY_SUFFIXES = (
    "Group", "Holdings", "Partners", "Trading", "Industries", "Foods",
    "Agro", "Ventures", "Supply", "Commodities", "Logistics", "Enterprises",
)
FIRST_NAMES = (
    "Ada", "Bruno", "Clara", "Dario", "Elena", "Felix", "Greta", "Hugo", "Irene", "Jonas",
    "Karin", "Luca", "Maya", "Nils", "Olga", "Pavel", "Rosa", "Sami", "Tara", "Umar",
    "Vera", "Wren", "Xavier", "Yara", "Zane", "Alma", "Boris", "Celia", "Dmitri", "Edith",
    "Farah", "Gideon", "Hana", "Ivo", "Jana", "Kofi", "Lena", "Milo", "Nora", "Otto",
)
WORDS = (
    "amber", "basin", "cedar", "delta", "ember", "fjord", "grove", "harbor", "island", "juniper",
    "kestrel", "lagoon", "meadow", "nectar", "orchard", "prairie", "quarry", "ridge", "savanna", "timber",
    "upland", "valley", "willow", "yonder", "zephyr", "anchor", "beacon", "canyon", "dune", "estuary",
    "falcon", "glacier", "heron", "inlet", "jasper", "knoll", "lantern", "marsh", "nimbus", "oasis",
)
INITIALS = tuple(chr(c) for c in range(ord("A"), ord("Z") + 1))
MANUFACTURING_SUFFIX = " Manufacturing"
# Hex digits of a fallback token (96 bits: distinct values do not meet).
FALLBACK_DIGITS = 24


def _pick(words: Sequence[str], h: Column, slot: int) -> Column:
    """Word chosen by hex digits [8*slot, 8*slot+8) of the hash ``h``."""
    idx = F.pmod(F.conv(F.substring(h, 1 + 8 * slot, 8), 16, 10).cast("bigint"), F.lit(len(words)))
    return F.element_at(F.array(*[F.lit(w) for w in words]), (idx + 1).cast("int"))


def fake_base(category: Column, h: Column) -> Column:
    company = F.concat_ws(" ", _pick(SURNAMES, h, 0), _pick(SURNAMES, h, 2), _pick(COMPANY_SUFFIXES, h, 1))
    person = F.concat_ws(" ", _pick(FIRST_NAMES, h, 0), F.concat(_pick(INITIALS, h, 2), F.lit(".")),
                         _pick(SURNAMES, h, 1))
    return (F.when(category == "company", company)
             .when(category == "manufacturing", F.concat(company, F.lit(MANUFACTURING_SUFFIX)))
             .when(category == "person", person)
             .otherwise(capitalize(_pick(WORDS, h, 0))))


def salted_hash(original: Column, salt: str) -> Column:
    return F.sha2(F.concat(F.lit(salt), F.lit("\u001f"), original), 256)


# --- occurrences and first-seen order ---------------------------------------

def first_seen(rows: DataFrame, order: Sequence[str], columns: Sequence[str], strip: bool, numbered: bool = False) -> DataFrame:
    """``(original, __j, __rk, __in)``: first occurrence of each non-blank value over
    ``columns``: position of the column in the list, then the number of its row in
    ``order``; ``__in`` has a bit for every column that holds the value. Rows are numbered
    first, so that an occurrence is one long and the smallest per value a hash
    aggregate (the smallest of a whole row key sorts every cell). Without an
    ``order`` there is no ``__rk`` (a name's category asks for no more); ``numbered`` rows
    have their number in the one column of ``order``."""
    present = [c for c in columns if c in rows.columns]
    if order and numbered:
        rows = rows.select(*cols(present), col(order[0]).alias("__seq"))
    elif order:
        kept = [c for c in dict.fromkeys([*order, *present])]
        rows = dense_number(rows.select(*cols(kept)), list(order), id_col="__seq", start=0, drop=[c for c in order if c not in present])
    occ = F.explode(F.array(*[
        F.struct(F.lit(columns.index(c)).alias("j"), col(c).cast("string").alias("v")) for c in present]))
    x = rows.select(*(["__seq"] if order else []), occ.alias("o")).select(*(["__seq"] if order else []), "o.j", "o.v")
    if strip:
        x = x.where(~_id_blank(F.col("v"))).withColumn("v", py_strip(F.col("v")))
    else:
        x = x.where(~is_blank(F.col("v")))
    held = F.bit_or(F.element_at(F.array(*[F.lit(_bit(i)) for i in range(len(columns))]), F.col("j") + 1)).alias("__in")
    if not order:
        return x.groupBy(F.col("v").alias("original")).agg(F.min("j").alias("__j"), held)
    place = F.shiftleft(F.col("j").cast("bigint"), _ROW_BITS) + F.col("__seq")
    first = x.groupBy(F.col("v").alias("original")).agg(F.min(place).alias("__f"), held)
    return first.select("original", F.shiftright("__f", _ROW_BITS).cast("int").alias("__j"),
                        F.col("__f").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("__rk"), "__in")


#: Bits of an occurrence's row number; the column's position stands above them.
_ROW_BITS = 48


def _bit(j: int) -> int:
    """Bit of the ``j``-th column. Beyond 62 columns some share one: a bit that is set may
    then mean another column, one that is not set never does."""
    return 1 << j % 62


def _id_blank(c: Column) -> Column:
    return c.isNull() | py_strip(c).isin(*ID_BLANK_TOKENS)


def _by_position(values: Sequence[str], j: Column) -> Column:
    """The ``j``-th (0-based) of a list of literals, chosen per row."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (j + 1).cast("int"))


# --- name mapping -------------------------------------------------------------

def empty_name_map(spark) -> DataFrame:
    return spark.createDataFrame([], "original string, anonymized string, category string")


def empty_id_map(spark) -> DataFrame:
    return spark.createDataFrame([], "original string, fake string, id_type string")


def is_keyed(mapping) -> bool:
    """Whether a saved mapping answers by key instead of being a DataFrame."""
    return hasattr(mapping, "lookup")


def _missing(first: DataFrame, existing) -> DataFrame:
    return existing.missing(first) if is_keyed(existing) else first.join(existing.select("original"), "original", "left_anti")


def suffix_numbers(entries: DataFrame) -> DataFrame:
    """``(__base, __n)``: suffix numbers used per base by saved fakes ("base" counts as 1)."""
    m = F.regexp_extract(F.col("anonymized"), r"^(.*) (\d+)$", 2)
    return entries.select(
        F.when(m != "", F.regexp_extract(F.col("anonymized"), r"^(.*) (\d+)$", 1)).otherwise(F.col("anonymized")).alias("__base"),
        F.when(m != "", m.cast("bigint")).otherwise(F.lit(1)).alias("__n"))


def build_name_map(first: DataFrame, columns: Sequence[str], existing: DataFrame | None = None, *, salt: str) -> DataFrame:
    """Mapping entries for the values that ``existing`` does not have."""
    spark = first.sparkSession
    existing = existing if existing is not None else empty_name_map(spark)
    new = _missing(first, existing)
    category = _by_position([name_category(c) for c in columns], F.col("__j"))
    h = salted_hash(F.col("original"), salt)
    new = new.select("original", category.alias("category"), h.alias("__h"))
    new = new.withColumn("__base", fake_base(F.col("category"), F.col("__h")))
    rank = F.row_number().over(Window.partitionBy("__base").orderBy("__h", "original"))
    if is_keyed(existing):
        new = existing.with_used(new)
    else:
        new = new.join(suffix_numbers(existing).groupBy("__base").agg(F.max("__n").alias("__used")), "__base", "left")
    new = new.withColumn("__n", rank + F.coalesce(F.col("__used"), F.lit(0)))
    fake = F.when(F.col("__n") == 1, F.col("__base")).otherwise(
        F.concat_ws(" ", F.col("__base"), F.col("__n").cast("string")))
    return new.select("original", fake.alias("anonymized"), "category")


# --- identifier mapping --------------------------------------------------------

def id_counters(existing: DataFrame) -> DataFrame:
    """Highest number used per type in a saved mapping (suffix after the last
    ``_``; a suffix that is not a number is ignored)."""
    return existing.groupBy("id_type").agg(F.max(last_number(F.col("fake"))).alias("__counter"))


def build_id_map(first: DataFrame, columns: Sequence[str], existing: DataFrame | None = None,
                 width: int = 6, *, salt: str) -> DataFrame:
    spark = first.sparkSession
    existing = existing if existing is not None else empty_id_map(spark)
    new = _missing(first, existing)
    typ = _by_position([id_type(c) for c in columns], F.col("__j"))
    new = new.withColumn("id_type", typ)
    seq = new.where(F.col("id_type") != "OTHER")
    other = new.where(F.col("id_type") == "OTHER")
    numbered = dense_number(seq, ["__j", "__rk"], id_col="__n", groups=["id_type"])
    # One row per id type: bounded by the handful of types, safe to broadcast.
    counters = F.broadcast(existing.counters() if is_keyed(existing) else id_counters(existing))
    numbered = numbered.join(counters, "id_type", "left").withColumn(
        "__n", F.col("__n") + F.coalesce(F.col("__counter"), F.lit(0)))
    prefix = F.element_at(F.create_map(*[F.lit(x) for kv in ID_PREFIX.items() for x in kv]), F.col("id_type"))
    seq_fake = F.concat(prefix, zfill(F.col("__n"), width))
    fallback = F.concat(F.lit("FAKE_"), F.substring(salted_hash(F.col("original"), salt), 1, FALLBACK_DIGITS))
    return numbered.select("original", seq_fake.alias("fake"), "id_type").unionByName(
        other.select("original", fallback.alias("fake"), "id_type"))


# --- applying a mapping --------------------------------------------------------

def apply_mapping(df: DataFrame, columns: Sequence[str], mapping: DataFrame, value_col: str,
                  strip: bool, strategy: str = "auto", asked: DataFrame | None = None) -> DataFrame:
    """Replace each listed column by its mapped value; blank → ``""``.

    ``mapping`` should be a written table so its size is known. Up to the
    broadcast threshold, each column is a broadcast lookup (no shuffle).
    Beyond it, every column meets the entries of its own values (``asked``: the written
    ``first_seen`` of ``columns``): most columns have few and are still a
    broadcast lookup; only a column with many values moves the rows, once.
    """
    return _apply(df, columns, mapping, value_col, strip, strategy, asked, None)[0].select(*cols(df.columns))


def _apply(df: DataFrame, columns: Sequence[str], mapping, value_col: str, strip: bool, strategy: str, asked: DataFrame | None,
           base: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """``apply_mapping`` and, inside ``parts.in_place``, the pinned rows it left where they are. ``base``
    are the pinned rows that ``df`` is made of, with these columns as they are in ``df``."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df, base
    if is_keyed(mapping):
        strategy = "unpivot"
    if strategy == "auto":
        limit = broadcast_limit(df.sparkSession)
        strategy = "broadcast" if 0 <= size_in_bytes(mapping) <= limit else "unpivot"
    if strategy == "broadcast":
        return _apply_broadcast(df, present, mapping, value_col, strip), base
    if asked is None:
        asked = materialize(first_seen(df, (), columns, strip), "asked-values")
    return _apply_by_column(df, columns, present, mapping, value_col, strip, asked, base)


def _blank_key(c: Column, strip: bool) -> tuple[Column, Column]:
    blank = _id_blank(c) if strip else is_blank(c)
    key = py_strip(c) if strip else c
    return blank, key.cast("string")


def _apply_broadcast(df, present, mapping, value_col, strip):
    # Size checked by the caller: at most the broadcast threshold.
    m = F.broadcast(mapping.select(F.col("original").alias("__mo"), F.col(value_col).alias("__mv")))
    x = df
    for c in present:
        blank, key = _blank_key(col(c), strip)
        x = (x.withColumn("__b", blank).withColumn("__k", F.when(F.col("__b"), F.lit(None)).otherwise(key))
              .join(m, F.col("__k") == F.col("__mo"), "left")
              .withColumn(c, F.when(F.col("__b"), F.lit("")).otherwise(F.col("__mv")))
              .drop("__b", "__k", "__mo", "__mv"))
    return x.select(*cols(df.columns))


#: Rough bytes of a broadcast entry beside its two texts.
ENTRY_BYTES = 64
#: Parts that a hot "no value" is dealt into.
BLANK_PARTS = 1024


def _apply_by_column(df, columns, present, mapping, value_col, strip, asked, base):
    limit = broadcast_limit(df.sparkSession)
    own = {c: F.col("__in").bitwiseAND(F.lit(_bit(columns.index(c)))) != 0 for c in present}
    # One number per column: what its own entries would take. A masked text is taken for as
    # long as its original or a generated name.
    size = F.lit(ENTRY_BYTES) + F.octet_length("original") + F.greatest(F.octet_length("original"), F.lit(ENTRY_BYTES))
    sizes = asked.agg(*[F.coalesce(F.sum(F.when(own[c], size)), F.lit(0)).alias(f"s{i}") for i, c in enumerate(present)]).first()
    small = [sizes[f"s{i}"] <= limit for i in range(len(present))]
    if base is None and parts.staying(df.sparkSession) and small.count(False) > 1:
        df = base = parts.pin_parts(df, "rows-to-mask")
    x = df
    # Large columns first: rows move with the short originals of the small columns, which need no
    # exchange, and not with the longer texts that replace them.
    for i, c in sorted(enumerate(present), key=lambda ic: small[ic[0]]):
        keys = asked.where(own[c]).select(F.col("original").alias("__mo"))
        if is_keyed(mapping):
            found = mapping.lookup(keys, "__mo", value_col, "__mv")
        else:
            entries = mapping.select(F.col("original").alias("__mo"), F.col(value_col).alias("__mv"))
            found = entries.join(F.broadcast(keys), "__mo", "left_semi") if small[i] else entries.join(keys, "__mo", "left_semi")
        blank, key = _blank_key(col(c), strip)
        x = x.withColumn("__b", blank).withColumn("__k", F.when(F.col("__b"), F.lit(None)).otherwise(key))
        if small[i]:
            x = x.join(F.broadcast(found), F.col("__k") == F.col("__mo"), "left")
        elif base is not None:
            own_blank, own_key = _blank_key(base[f"`{c}`"], strip)
            told = parts.answers(base, {"__k": F.when(~own_blank, own_key)}, found.withColumnRenamed("__mo", "__k"))
            x = x.join(told, [parts.PART, "__k"], "left").withColumn("__mo", F.col("__k"))
        else:
            # A column's entries have each key once, so a task's part of them is small: the rows
            # need no sort. Blank rows meet nothing and are dealt by their other columns.
            part = F.when(F.col("__b"), 1 + F.pmod(F.xxhash64(*cols(df.columns)), F.lit(BLANK_PARTS))).otherwise(F.lit(0)).cast("int")
            x = x.withColumn("__s", part).withColumn("__k", F.coalesce("__k", F.lit("")))
            found = found.withColumn("__z", F.lit(0)).hint("shuffle_hash")
            x = x.join(found, (F.col("__k") == F.col("__mo")) & (F.col("__s") == F.col("__z")), "left").drop("__s", "__z")
        x = x.withColumn(c, F.when(F.col("__b"), F.lit("")).otherwise(F.col("__mv"))).drop("__b", "__k", "__mo", "__mv")
    return x.select(*cols(df.columns)), base


class _NewAndKeyed:
    """Entries just made, and keyed storage for all others."""

    def __init__(self, new: DataFrame, saved):
        self.new, self.saved = new, saved

    def lookup(self, keys: DataFrame, key: str, value: str, as_value: str) -> DataFrame:
        made = keys.join(self.new.select(F.col("original").alias(key), F.col(value).alias(as_value)), key)
        return self.saved.lookup(keys, key, value, as_value).unionByName(made)


def _with_saved(new: DataFrame, saved):
    if saved is None:
        return new
    if is_keyed(saved):
        return _NewAndKeyed(new, saved)
    return saved.select(*[c for c in new.columns if c in saved.columns]).unionByName(new, allowMissingColumns=True)


# --- one call: both namespaces ----------------------------------------------------

def pseudonymize(df: DataFrame, order: Sequence[str], name_columns: Sequence[str] = (),
                 id_columns: Sequence[str] = (), name_map: DataFrame | None = None, id_map: DataFrame | None = None,
                 width: int = 6, keep_input: bool = False, strategy: str = "auto", *, salt: str, masked_rows: Callable | None = None, numbered: bool = False):
    """Mask names and identifiers. Returns ``(masked, new names, new ids)``: the
    mapping entries this call added to ``name_map`` and ``id_map``, written once;
    the values are looked up in both together.

    ``order`` is the total row order (file order of the source). ``salt`` keeps
    fakes from being rebuilt out of guessed originals; keep it secret and apart
    from the data. ``numbered``: ``order`` is one column that has the rows' numbers.

    Inside ``parts.in_place`` the rows stay where they are written, and ``masked`` has to be written inside.

    Where ``df`` is a join, ``masked_rows(columns, mask)`` may make it again with ``mask(table,
    columns)`` done in the tables that the name columns come from (``adapter.masked_staging``), with
    ``keep_input`` by ``masked_rows(columns, mask, True)`` and the unmasked values as ``__in_<column>``.
    """
    listed = [c for c in (*name_columns, *id_columns) if c in df.columns]
    skipped = [c for c in (*name_columns, *id_columns) if c not in df.columns]
    if skipped:
        warnings.warn(f"columns to mask not present, skipped: {skipped}")
    rows = df.select(*[col(c) for c in dict.fromkeys([*order, *listed])])
    masked, at_tables = df, masked_rows is not None and bool(name_columns)
    if keep_input and not at_tables:
        masked = masked.select("*", *[col(c).alias(f"__in_{c}") for c in listed])
    out_names = out_ids = None
    base = df if parts.PART in df.columns and parts.staying(df.sparkSession) else None
    if name_columns:
        asked = materialize(first_seen(rows, (), name_columns, strip=False), "names-seen")
        out_names = materialize(build_name_map(asked, name_columns, name_map, salt=salt), "name-map")
        found = _with_saved(out_names, name_map)

        def mask(x: DataFrame, present: Sequence[str]) -> DataFrame:
            own = [c if c in present else None for c in name_columns]
            return apply_mapping(x, own, found, "anonymized", strip=False, strategy=strategy, asked=asked)

        if not at_tables:
            masked, base = _apply(masked, name_columns, found, "anonymized", False, strategy, asked, base)
        else:
            masked = masked_rows([c for c in name_columns if c in df.columns], mask, *([True] if keep_input else []))
            if keep_input:
                masked = masked.select("*", *[col(c).alias(f"__in_{c}") for c in listed if c not in name_columns])
    if id_columns:
        asked = materialize_only(lambda: first_seen(rows, order, id_columns, strip=True, numbered=numbered), "ids-seen")
        out_ids = materialize_only(lambda: build_id_map(asked, id_columns, id_map, width, salt=salt), "id-map")
        if set(id_columns) & set(name_columns):
            base = None  # its values are masked by now
        masked = _apply(masked, id_columns, _with_saved(out_ids, id_map), "fake", True, strategy, asked, base)[0]
    kept = [col(f"__in_{c}") for c in listed] if keep_input else []
    return masked.select(*[col(c) for c in df.columns], *kept), out_names, out_ids


def leak_report(masked: DataFrame, columns: Sequence[str], namespace: Sequence[str]) -> DataFrame:
    """Per column of a ``pseudonymize(..., keep_input=True)`` result: rows
    whose output still equals the input, and output values found among the
    input values of any ``namespace`` column (left-semi join against the
    distinct inputs). Both must be 0 for a masked column.

    The rows are read once: cells are counted per (column, value) before anything is joined, so
    a hot value is one row, and those counts are written."""
    spark = masked.sparkSession
    one = [F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("v"), (col(c) == col(f"__in_{c}")).alias("same")) for c in columns]
    own = [F.struct(F.lit(None).cast("string").alias("column"), col(f"__in_{c}").cast("string").alias("v"), F.lit(None).cast("boolean").alias("same")) for c in namespace]
    cells = masked.select(F.explode(F.array(*one, *own)).alias("r")).select("r.*").groupBy("column", "v", "same").agg(F.count(F.lit(1)).alias("n"))
    with freed_shuffles(spark):
        cells = materialize(cells, "leak-cells")
    inputs = cells.where(F.col("column").isNull() & F.col("v").isNotNull()).select("v")
    outputs = cells.where(F.col("column").isNotNull())
    rows = outputs.groupBy("column").agg(F.sum("n").alias("n_rows"), F.sum(F.when(F.col("same"), F.col("n"))).alias("n_unchanged"))
    exposed = outputs.join(inputs, "v", "left_semi").groupBy("column").agg(F.sum("n").alias("n_exposed"))
    listed = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    return (listed.join(rows, "column", "left").join(exposed, "column", "left")
                  .select("column", *[F.coalesce(F.col(n), F.lit(0).cast("bigint")).alias(n) for n in ("n_rows", "n_unchanged", "n_exposed")]))


# --- originals inside longer values ------------------------------------------------------------

#: Values that may hold a run before it is looked up apart from the others.
HOT_RUNS = 100_000


def word_text(c: Column) -> Column:
    """A value's words, lower-cased, with single spaces between them."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "))


def embedded_leaks(outputs: DataFrame, columns: Sequence[str], originals: DataFrame, original: str = "original") -> DataFrame:
    """Per column of ``outputs``: ``n_rows``, ``n_whole`` (rows whose value is an original) and
    ``n_inside`` (rows that hold an original's words as a run inside a longer value).

    Originals are indexed by their word run. A value is asked only for runs of lengths
    that some original has; distinct values are counted before they are taken apart, so a hot
    value is one row, and no value meets an original it does not hold.
    """
    index = originals.select(word_text(col(original).cast("string")).alias("__run")).where(F.col("__run") != "").distinct()
    words = F.size(F.split("__run", " "))
    # One number per distinct length of an original.
    lengths = sorted(r[0] for r in index.select(words).distinct().collect())
    cells = outputs.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("v")) for c in columns])).alias("r")).select("r.*")
    rows = cells.groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"))
    values = cells.where(F.col("v").isNotNull()).groupBy("column", word_text(F.col("v")).alias("__t")).agg(F.count(F.lit(1)).alias("__n"))
    if not lengths:
        none = F.lit(0).cast("bigint")
        return rows.select("column", "n_rows", none.alias("n_whole"), none.alias("n_inside"))
    w = F.split("__t", " ")

    def runs_of(n: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) >= n, cut).otherwise(F.array().cast("array<string>"))

    runs = F.flatten(F.array(*[runs_of(n) for n in lengths]))
    asked = values.select("column", "__t", "__n", F.explode(F.array_distinct(runs)).alias("__run"))
    # Runs of a fixed wording are in every value. The frequent ones (few: at most all runs by
    # ``HOT_RUNS``) are looked up once each, so that no key brings its values to one task.
    hot = asked.groupBy("__run").agg(F.count(F.lit(1)).alias("__c")).where(F.col("__c") > HOT_RUNS).select("__run")
    hot = materialize(hot.join(index.withColumn("__held", F.lit(True)), "__run", "left"), "frequent-runs")
    dealt = asked.join(F.broadcast(hot.select(F.col("__run").alias("__hot"), F.coalesce("__held", F.lit(False)).alias("__held"))), F.col("__run") == F.col("__hot"), "left")
    rare = dealt.where(F.col("__hot").isNull()).join(index, "__run", "left_semi")
    held = dealt.where("__held").unionByName(rare).drop("__hot", "__held")
    each = held.groupBy("column", "__t").agg(F.max("__n").alias("__n"), F.max((F.col("__run") == F.col("__t")).cast("int")).alias("__whole"))
    found = each.groupBy("column").agg(F.sum(F.when(F.col("__whole") == 1, F.col("__n")).otherwise(0)).alias("n_whole"),
                                       F.sum(F.when(F.col("__whole") == 0, F.col("__n")).otherwise(0)).alias("n_inside"))
    zero = F.lit(0).cast("bigint")
    return rows.join(found, "column", "left").select("column", "n_rows", F.coalesce("n_whole", zero).alias("n_whole"), F.coalesce("n_inside", zero).alias("n_inside"))
