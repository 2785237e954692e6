"""Benchmark decontamination by templates.

A text is canonicalised word by word: punctuation goes, numbers, units and names (capitalised words within a sentence) become typed
placeholders, the rest is lower-cased. Windows of five template words of the items are joined by hash to those of the documents; an
item is a candidate where a document holds CONTAINED of its windows. Case and punctuation tell names,
and a copy in other case or without punctuation has others, so each window with a name is also read without. Whether the first word of
a sentence is a name can't be told, so each window with such a capitalised word is also read with all capitalised words as names. A
window is held if any reading of it is. Then the slots are compared along the diagonal that most windows share: the placeholders of the item must stand for
the same words throughout, though the words may be others than the item's. So a question asked with other numbers or names is caught,
and one that merely has the same shape in parts is not. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galecast.llm.shared import stored
from galecast.llm.text import WORD

WINDOW = 5
#: Share of an item's windows that a document must hold, and share of its slots that must be filled consistently.
CONTAINED = 0.8
#: Marks of the placeholders.
NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
#: Units of measure, money and time, lower-cased.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces "
    "ton tons ml l liter liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month months year "
    "years km/h mph % percent dollar dollars euro euros usd eur cent cents °c °f degree degrees w kw kwh v hz"
).split()
PUNCTUATION = '.,;:!?"()[]{}|*$€£'
_NAME, _FIRST = r"\u0001", r"\u0004"
_NUMBER = r"^[-+]?[0-9][0-9/%-]*[a-z°]{0,3}$"
_CAPITAL_FIRST = r"^[^\p{L}\p{N}]*\p{Lu}"
#: A capitalised word that _INNER_CAPITAL has not marked: at the start of a sentence or behind a quotation mark.
_OTHER_CAPITAL = r"(^|[\x20\x09-\x0D])([^\p{L}\p{N}\x01°\x20\x09-\x0D]*\p{Lu})"
_INNER_CAPITAL = r"([^.!?:;\x20\x09-\x0D][\x20\x09]+)(\p{Lu})"


def _tokens(text: str) -> str:
    """SQL for the lower-cased words of a text without punctuation, those that are or may be names marked in front."""
    marked = f"regexp_replace({text}, r'{_INNER_CAPITAL}', '$1\\u0001$2')"
    marked = f"regexp_replace({marked}, r'{_OTHER_CAPITAL}', '$1\\u0004$2')"
    return f"regexp_extract_all(translate(lower({marked}), '{PUNCTUATION}', ''), r'{WORD}', 0)"


def _typed(word: str) -> str:
    """The template word of a word that is not marked."""
    units = ", ".join(f"'{unit}'" for unit in UNITS)
    return f"case when {word} < ':' and {word} rlike r'{_NUMBER}' then '\\u0002' when {word} in ({units}) then '\\u0003' else {word} end"


def _template(tokens: str) -> str:
    return f"transform({tokens}, w -> case when startswith(w, '{_NAME}') then '{_NAME}' when startswith(w, '{_FIRST}') then {_typed('substring(w, 2)')} else {_typed('w')} end)"


def _windows(template: str, size: int = WINDOW) -> str:
    """Hashes of the windows by position; a shorter text is one window, an empty one has none."""
    return (
        f"case when size({template}) = 0 then array() when size({template}) < {size} then array(xxhash64({template})) "
        f"else transform(sequence(1, size({template}) - {size - 1}), i -> xxhash64(slice({template}, i, {size}))) end"
    )


def with_template(df: DataFrame, text: str = "text") -> DataFrame:
    """df with `words`, `template`, its other readings `plain` (no word is a name) and `named` (nor is a capitalised word anything
    else), and `windows` (arrays; a null text has no words)."""
    df = df.withColumn("words", F.expr(_tokens(f"coalesce({text}, '')")))
    df = df.withColumn("template", F.expr(_template("words")))
    plain = f"transform(words, (w, i) -> if(template[i] = '{_NAME}', {_typed('substring(w, 2)')}, template[i]))"
    df = df.withColumn("plain", F.expr(f"if(array_contains(template, '{_NAME}'), {plain}, template)"))
    df = df.withColumn("named", F.expr(f"transform(words, (w, i) -> if(startswith(w, '{_FIRST}'), '{_NAME}', template[i]))"))
    return df.withColumn("windows", F.expr(_windows("template")).cast("array<bigint>"))


def _others(named: bool = True) -> str:
    """Hashes of the windows of with_template whose other readings differ; named: with `named` among these."""
    ends = f"sequence(greatest(1, p - {WINDOW - 1}), least(p, greatest(1, size(words) - {WINDOW - 1})))"

    def hashes(reading: str, mark: str) -> str:
        at = f"transform(filter(sequence(1, size(words)), p -> startswith(words[p - 1], '{mark}')), p -> {ends})"
        return f"transform(array_distinct(flatten({at})), i -> xxhash64(slice({reading}, i, {WINDOW})))"

    more = hashes("named", _FIRST) if named else "array()"
    return f"if(size(words) = 0, cast(array() as array<bigint>), concat({hashes('plain', _NAME)}, {more}))"


def _readings(*others: str) -> str:
    """The distinct hashes of each window of with_template and of its other readings, by position."""
    more = ", ".join(f"xxhash64(slice({reading}, i + 1, {WINDOW}))" for reading in others)
    return f"transform(windows, (h, i) -> array_distinct(array(h, {more})))"


def _as_names(words: str, template: str) -> str:
    """The words, all capitalised ones but units marked as names, so that a name is the same wherever it stands."""
    return f"transform({words}, (w, i) -> if(startswith(w, '{_FIRST}'), concat(if({template}[i] = '{UNIT}', '', '{_NAME}'), substring(w, 2)), w))"


def row_keys(row_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two hashes that tell documents apart; rows equal in id and text are one document."""
    return [F.xxhash64(row_id, F.lit(1)).alias("_a"), F.xxhash64(text, F.lit(2)).alias("_b")]


def _items(benchmark: DataFrame) -> DataFrame:
    items = with_template(benchmark.select("item_id", "text")).withColumn("_i", F.xxhash64("item_id", "text", F.col("item_id").isNull()))
    items = items.where("size(words) > 0").dropDuplicates(["_i"])
    # The first word of an item may stand within a sentence of a document, and so count as a name there.
    first = f"if(i = 0 and text rlike r'{_CAPITAL_FIRST}', array(xxhash64(concat(array('{_NAME}'), slice(template, 2, {WINDOW - 1})))), array())"
    known = f"transform({_readings('plain')}, (of, i) -> array_distinct(concat(of, {first})))"
    named = f"transform(known, (of, i) -> array_distinct(concat(of, array(xxhash64(slice(named, i + 1, {WINDOW}))))))"
    return items.withColumn("known", F.expr(known)).withColumn("readings", F.expr(named))


def _index(items: DataFrame) -> DataFrame:
    """h, _i, pos, needed. A position has a row for each reading of `readings`."""
    needed = F.ceil(F.size("windows") * F.lit(CONTAINED)).alias("needed")
    at = items.select("_i", needed, F.posexplode("readings").alias("pos", "of"))
    return at.select("_i", "needed", "pos", F.explode("of").alias("h"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """_a, _b, item_id, windows_held, exact: a row for each document (by row_keys) and item it holds.

    exact: every slot is filled as in the item. An item of fewer than five words is held only by a text of the same few.
    Items without words are never held. The join is by window hash; Spark broadcasts the index only if it is below its
    threshold. Joined are distinct windows of a document, and counted before the shuffle. The candidates are stored: few where
    the documents are clean, and then no text is shuffled to compare their slots.
    """
    items = _items(benchmark)
    told = with_template(docs.select(*row_keys(), "text"))
    held = told.select("_a", "_b", F.explode(F.array_distinct(F.concat("windows", F.expr(_others())))).alias("h"))
    found = held.join(_index(items), "h").groupBy("_a", "_b", "_i").agg(F.collect_set("pos").alias("at"), F.max("needed").alias("needed"))
    found = found.where("size(at) >= needed").select("_a", "_b", "_i", "needed", F.size("at").alias("windows_held"))
    found = stored(found, "leaks")
    texts = docs.select(*row_keys(), "text").join(found.select("_a", "_b").distinct(), ["_a", "_b"], "left_semi")
    texts = with_template(texts.dropDuplicates(["_a", "_b"])).select("_a", "_b", F.col("words").alias("doc_words"), F.col("template").alias("doc_template"), F.col("named").alias("doc_named"), F.expr(_readings("plain", "named")).alias("doc_readings"), F.expr(f"concat(windows, {_others(named=False)})").alias("doc_windows"))
    both = found.join(items.drop("text", "plain"), "_i").join(texts, ["_a", "_b"])
    places = F.expr("transform(readings, (h, i) -> transform(filter(sequence(0, size(doc_readings) - 1), j -> arrays_overlap(doc_readings[j], h)), j -> j - i))")
    shift = F.expr("array_max(transform(array_distinct(shifts), s -> struct(size(filter(shifts, t -> t = s)) as n, -s as back))).back * -1")
    # As elements of exploded arrays, or these would be copied into the filter and evaluated for each word.
    once = lambda df, name, value: df.select("*", F.explode(F.array(value)).alias(name))
    both = once(once(both, "shifts", F.flatten(places)), "shift", shift)
    both = once(both.withColumnRenamed("words", "w"), "words", F.expr(_as_names("w", "template")))
    both = once(both.withColumnRenamed("doc_words", "v"), "doc_words", F.expr(_as_names("v", "doc_template")))
    typed = f"template[p] in ('{NAME}', '{NUMBER}', '{UNIT}') and doc_template[p + shift] = template[p]"
    renamed = f"named[p] = '{NAME}' and doc_named[p + shift] = '{NAME}' and words[p] <> doc_words[p + shift]"
    within = "filter(sequence(0, size(words) - 1), p -> p + shift >= 0 and p + shift < size(doc_words))"
    slots = lambda which: F.expr(f"transform(filter({within}, p -> {which}), p -> struct(words[p] as a, doc_words[p + shift] as b))")
    both = once(once(both, "slots", slots(f"({typed}) or ({renamed})")), "typed", slots(typed))
    consistent = lambda of: F.expr(f"(size(array_distinct({of})) - size(array_distinct({of}.a))) <= {1 - CONTAINED} * size({of})")
    # What the names within sentences alone tell is held whatever else may be a name.
    told = F.expr(f"size(filter(known, of -> arrays_overlap(doc_windows, of))) >= needed")
    both = both.where(consistent("slots") | (told & consistent("typed")))
    return both.select("_a", "_b", "item_id", "windows_held", F.expr("forall(slots, s -> s.a = s.b)").alias("exact"))


def checked_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, n_changed (items held with other slots) and item_ids (ascending, comma-separated) of every
    document. Equal rows get equal verdicts; empty tables give an empty result, or no contaminated document."""
    held = leaks(docs, benchmark).groupBy("_a", "_b").agg(
        F.count("*").alias("n_items"),
        F.count_if(~F.col("exact")).alias("n_changed"),
        F.array_join(F.sort_array(F.collect_list("item_id")), ",").alias("item_ids"),
    )
    slim = docs.select("doc_id", *row_keys())
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    return slim.join(held, ["_a", "_b"], "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), zero("n_items"), zero("n_changed"), F.coalesce("item_ids", F.lit("")).alias("item_ids")
    )


def contaminated_removed(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item, with the columns of docs."""
    bad = leaks(docs, benchmark).select("_a", "_b").distinct()
    return docs.select(F.struct("*").alias("_all"), *row_keys()).join(bad, ["_a", "_b"], "left_anti").select("_all.*")
