"""Benchmark decontamination by template windows, in DataFrame operations.

Documents and benchmark items are turned into templates, token by token:
numbers, units behind numbers and names (capitals inside a sentence) become
typed placeholders, all else goes to lower case without punctuation.  Windows
of `window` template tokens are hash-joined, so an item is found however its
numbers and names are changed.  Joined windows are compared in full, and their
slots are checked along each alignment: a value of the item must have the same
counterpart wherever it comes up, else the alignment is no re-parameterised
copy and is dropped.  Windows with fewer than `literals` plain tokens say too
little and are no templates; an item of fewer than `window` tokens is one
window of its own length.

What is a name depends on case and spacing, and a copy may keep some values and
change others, so windows are also hash-joined by their plain words, with no
slots and no case.  A window that agrees word for word needs no template: it
counts however little it says, and whatever becomes of its alignment, where the
check of slots is then for windows with changed slots alone.

A document leaks an item if it holds `share_percent` of the item's windows, or
`run` tokens' worth of them, by templates alone or else by windows of either
kind.  Figures are those of the way that told.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.tables import id_and_text
from runlens.session import materialize

# Words taken for units behind a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres"
    " mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons"
    " ml cl l liter liters litre litres gallon gallons cup cups"
    " s sec min h hr hrs second seconds minute minutes hour hours day days week weeks month months year years"
    " dollar dollars cent cents euro euros usd eur percent degree degrees mph kmh"
).split()

NAME, NUMBER, UNIT, POINT = "\x01", "\x02", "\x03", "\x04"
ANY_UNIT = "|".join(sorted(UNITS, key=lambda x: (-len(x), x)))
#: (pattern, replacement) steps before and after lower-casing; groups as $1.
#: Those of NUMERIC change nothing in a text without digits.
BEFORE = [
    ("([0-9])[.,]([0-9])", f"$1{POINT}$2"),
    (r"([\p{Ll}0-9,;] )(\p{Lu})", f"$1{NAME}$2"),
]
AFTER = [
    (f"([0-9])({ANY_UNIT})([^\\p{{L}}0-9]|$)", "$1 $2$3"),
    (f"(^|[^\\p{{L}}0-9{POINT}])([0-9])", f"$1{NUMBER}$2"),
    (f"({NUMBER}[0-9{POINT}]+)[ -]?({ANY_UNIT})([^\\p{{L}}0-9]|$)", f"$1 {UNIT}$2$3"),
    (f"[^\\p{{L}}0-9{NAME}-{POINT}]+", " "),
]
NUMERIC = [BEFORE[0], *AFTER[:3]]
SLOT = (f"([{NAME}-{UNIT}])[^ ]+", "$1")
MARKS = f"('{NAME}', '{NUMBER}', '{UNIT}')"


@dataclass(frozen=True)
class Template:
    window: int = 8
    literals: int = 4
    share_percent: int = 50
    run: int = 13
    #: Windows of the benchmark, and their bytes, that are broadcast at most;
    #: more are shuffled.
    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 64 << 20


def marked(text: Column) -> Column:
    """The text's tokens, one space apart, slots behind their marks."""
    clear = reduce(lambda c, x: F.replace(c, F.lit(x), F.lit(" ")), (NAME, NUMBER, UNIT, POINT), text)

    def steps(numbers: bool) -> Column:
        before, after = ([x for x in all_ if numbers or x not in NUMERIC] for all_ in (BEFORE, AFTER))
        t = reduce(lambda c, x: F.regexp_replace(c, *x), before, clear)
        return F.trim(reduce(lambda c, x: F.regexp_replace(c, *x), after, F.lower(t)))

    return F.when(text.rlike("[0-9]"), steps(True)).otherwise(steps(False))


def _tokens(rows: DataFrame) -> DataFrame:
    """rows with `words` (tokens) and `shape` (the same with bare slots)."""
    kept = [c for c in rows.columns if c != "text"]
    with_marks = rows.select(*kept, marked(F.col("text")).alias("__marked"))
    both = F.struct(F.split("__marked", " ").alias("words"), F.split(F.regexp_replace("__marked", *SLOT), " ").alias("shape"))
    # a generator, so that the optimizer doesn't put these expressions in the
    # lambdas that use them, to be evaluated for each window
    return with_marks.select(*kept, F.inline(F.array(both)))


def plain(words: Column) -> Column:
    """Marked tokens without marks, as any case of the text gives them."""
    return reduce(lambda c, x: F.replace(c, F.lit(x[0]), F.lit(x[1])), ((NAME, ""), (NUMBER, ""), (UNIT, ""), ("ς", "σ"), ("ß", "ss")), words)


def _hash(token: Column) -> Column:
    return F.xxhash64(token)


def _hashed(rows: DataFrame) -> DataFrame:
    """_tokens, with the hash of each token's shape and of its plain word."""
    tokens = _tokens(rows)
    plain_words = F.split(plain(F.array_join("words", " ")), " ")
    hashes = F.struct(F.transform("shape", _hash).alias("shape_hash"), F.transform(plain_words, _hash).alias("plain_hash"))
    return tokens.select(*tokens.columns, F.inline(F.array(hashes)))


def _with_keys(rows: DataFrame, sizes: list[int]) -> tuple[DataFrame, list[tuple[int, bool, Column, Column]]]:
    """`_hashed` rows with `keys`: of all windows of each size by their plain
    words, then of those that hold a slot by their shape (without one it says
    the same).  And (size, by_shape, place of the first such key, place of the
    window of a key at `place`, from 1) of each part."""
    slots = F.expr("filter(sequence(1, size(shape)), i -> shape_hash[i - 1] != plain_hash[i - 1])")
    # generators keep the optimizer from putting these into the lambdas below
    marked_at = rows.select("*", F.inline(F.array(F.struct(slots.alias("slots")))))
    starts = {s: F.expr(f"if(size(shape) >= {s}, array_distinct(flatten(transform(slots, i -> sequence(greatest(1, i - {s - 1}), least(i, size(shape) - {s - 1}))))), array())") for s in sizes}
    begun = marked_at.select("*", F.inline(F.array(F.struct(*(x.alias(f"starts_{s}") for s, x in starts.items()))))).drop("slots")
    by_words = [f"if(size(shape) >= {s}, transform(sequence(1, size(shape) - {s - 1}), i -> xxhash64(slice(plain_hash, i, {s}))), array())" for s in sizes]
    by_shape = [f"transform(starts_{s}, i -> xxhash64(slice(shape_hash, i, {s})))" for s in sizes]
    first, parts = F.lit(0), []
    for s in sizes:
        parts.append((s, False, first, F.col("place") - first + 1))
        first = first + F.greatest(F.lit(0), F.size("shape") - (s - 1))
    for s in sizes:
        parts.append((s, True, first, F.get(F.col(f"starts_{s}"), F.col("place") - first)))
        first = first + F.size(f"starts_{s}")
    return begun.withColumn("keys", F.expr(f"concat({', '.join(by_words + by_shape)})")), parts


def item_windows(items: DataFrame, how: Template) -> DataFrame:
    """(key, by_shape, item_id, at, size, telling, n_telling, n_windows,
    item_words, item_shape, item_plain): windows by their plain words, and
    those that are templates with slots by their shape too."""
    own = _tokens(items.select("item_id", "text").distinct()).withColumn("size", F.least(F.lit(how.window), F.size("shape")))
    each = own.select("item_id", "size", "words", "shape", F.explode(F.expr("sequence(1, size(shape) - size + 1)")).alias("at"))
    cut = each.select("item_id", "at", "size", F.expr("slice(words, at, size)").alias("item_words"), F.expr("slice(shape, at, size)").alias("item_shape"))
    telling = F.expr(f"size(filter(item_shape, x -> x != '' and x not in {MARKS})) >= least({how.literals}, size)")
    full = cut.where("item_shape != array('')").withColumns({"telling": telling, "item_plain": plain(F.array_join("item_words", " "))})
    counts = full.groupBy("item_id").agg(F.count_distinct(F.when(F.col("telling"), F.col("at"))).alias("n_telling"), F.count_distinct("at").alias("n_windows"))
    ways = full.join(counts, "item_id").withColumn("by_shape", F.explode(F.array(F.lit(False), F.lit(True))))
    of = F.when(F.col("by_shape"), F.col("item_shape")).otherwise(F.split("item_plain", " "))
    return ways.where("not by_shape or telling and array_join(item_shape, ' ') != item_plain").withColumn("key", F.xxhash64(F.transform(of, _hash)))


def leaks(docs: DataFrame, benchmark: DataFrame, how: Template = Template(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(doc_id, text_key, item_id, n_windows, n_matched, n_slots, n_changed,
    kind) for each text that leaks an item; kind is `verbatim`, or `template`
    if a slot has another value than in the item.

    A null, empty or short text leaks nothing.  Rows without id are told apart
    by text_key, a hash of the text; equal rows give one row.
    """
    docs = id_and_text(docs, id_col, text_col)
    items = id_and_text(benchmark, item_col, text_col).withColumnRenamed("doc_id", "item_id")
    theirs = materialize(item_windows(items, how))
    size_of = F.sum(3 * F.octet_length("item_plain") + 512)
    n, n_bytes, sizes = theirs.agg(F.count(F.lit(1)), F.coalesce(size_of, F.lit(0)), F.collect_set("size")).first()
    # one size for all but items that are shorter than a window
    ours, parts = _with_keys(_hashed(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")), sorted(sizes) or [how.window])
    starts = [c for c in ours.columns if c.startswith("starts_")]
    each = ours.select("doc_id", "text_key", "words", "shape", *starts, F.posexplode("keys").alias("place", "key"))
    of_pair = ["doc_id", "text_key", "item_id", "n_telling", "n_windows"]
    # Rows leave the generated code with the words of a window alone, never
    # with those of the text: the join streams through a broadcast table, or
    # comes after the cut.  `inline` keeps the lambdas below out of that code.
    own = [F.expr(f"slice({c}, begin, size)").alias(f"own_{c}") for c in ("words", "shape")]
    if n <= how.broadcast_rows and n_bytes <= how.broadcast_bytes:
        begin = F.coalesce(*(F.when((F.col("size") == s) & (F.col("by_shape") == by_shape), at) for s, by_shape, _, at in parts))
        joined = each.join(F.broadcast(theirs), "key").withColumn("begin", F.greatest(begin, F.lit(1)))
        found = joined.select(*of_pair, "at", "begin", "telling", "item_words", "item_shape", "item_plain", F.inline(F.array(F.struct(*own))))
    else:
        ends = [x[2] for x in parts[1:]] + [F.lit(1 << 31)]
        by_part = [each.where((F.col("place") >= first) & (F.col("place") < end)).withColumns({"size": F.lit(s), "by_shape": F.lit(by_shape), "begin": at}) for (s, by_shape, first, at), end in zip(parts, ends, strict=True)]
        cut = [x.select("doc_id", "text_key", "key", "size", "by_shape", "begin", *own) for x in by_part]
        found = reduce(DataFrame.union, cut).join(theirs, ["key", "size", "by_shape"])
    literal = plain(F.array_join("own_words", " ")) == F.col("item_plain")
    slots = F.expr(f"filter(zip_with(item_words, own_words, (x, y) -> named_struct('a', x, 'b', y)), x -> substr(x.a, 1, 1) in {MARKS})")
    hits = found.select(*of_pair, "at", (F.col("begin") - F.col("at")).alias("shift"), slots.alias("slots"), literal.alias("literal"), F.expr("telling and own_shape = item_shape").alias("template"))
    kinds = {"template": F.col("template"), "literal": F.col("literal"), "changed": F.col("template") & ~F.col("literal")}
    along = hits.groupBy(*of_pair, "shift").agg(*(f for k, v in kinds.items() for f in (F.collect_set(F.when(v, F.col("at"))).alias(f"{k}_ats"), F.array_distinct(F.flatten(F.collect_set(F.when(v, F.col("slots"))))).alias(f"{k}_pairs"))))
    sound = {k: F.expr(f"size({k}_pairs) = size(array_distinct(transform({k}_pairs, x -> x.a)))") for k in ("template", "changed")}
    same = F.expr("array_distinct(transform(literal_pairs, x -> named_struct('a', x.a, 'b', x.a)))")
    ways = along.select(
        *of_pair,
        *(F.when(sound["template"], F.col(f"template_{x}")).otherwise(F.slice(f"template_{x}", 1, 0)).alias(f"template_{x}") for x in ("ats", "pairs")),
        *(F.when(sound["changed"], F.array_union(y, F.col(f"changed_{x}"))).otherwise(y).alias(f"either_{x}") for x, y in (("ats", F.col("literal_ats")), ("pairs", same))),
    )
    counts = ways.groupBy(*of_pair).agg(
        *(
            F.struct(
                F.size(F.array_distinct(F.flatten(F.collect_list(f"{k}_ats")))).cast("long").alias("n_matched"),
                F.sum(F.size(f"{k}_pairs")).alias("n_slots"),
                F.sum(F.expr(f"size(filter({k}_pairs, x -> x.a != x.b))")).alias("n_changed"),
            ).alias(k)
            for k in ("template", "either")
        )
    )
    enough = []
    for k, n in (("template", "n_telling"), ("either", "n_windows")):
        m = F.col(f"{k}.n_matched")
        figures = F.struct(F.col(n).alias("n_windows"), *(F.col(f"{k}.{x}").alias(x) for x in ("n_matched", "n_slots", "n_changed")))
        enough.append(F.when((m > 0) & ((100 * m >= how.share_percent * F.col(n)) | (m >= how.run - how.window + 1)), figures))
    leaked = counts.select("doc_id", "text_key", "item_id", F.coalesce(*enough).alias("told")).where("told is not null").select("doc_id", "text_key", "item_id", "told.*")
    return leaked.withColumn("kind", F.when(F.col("n_changed") > 0, "template").otherwise("verbatim"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, how: Template = Template(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that leak no item, with all their columns."""
    found = leaks(docs, benchmark, how, id_col, text_col).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))) == F.col("__key"))
    return docs.join(found, same, "left_anti")


def _duck(patterns: list[tuple[str, str]], text: str) -> str:
    for pattern, by in patterns:
        by = by.replace("$", "\\")
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return text


def _duck_tokens(table: str, key: str) -> str:
    plain = f"translate(coalesce(text, ''), '{NAME + NUMBER + UNIT + POINT}', '    ')"
    words = f"trim({_duck(AFTER, f'lower({_duck(BEFORE, plain)})')})"
    return f"select {key}, string_split(m, ' ') as words, string_split({_duck([SLOT], 'm')}, ' ') as shape from (select distinct {key}, {words} as m from {table})"


def duck_sql(how: Template = Template()) -> str:
    """DuckDB SQL for `leaks` without text_key, where ids are unique: windows
    joined by shape and by plain words, each way with its check of slots."""
    marks = f"('{NAME}', '{NUMBER}', '{UNIT}')"
    plain_of = f"replace(translate(array_to_string({{}}, ' '), 'ς{NAME}{NUMBER}{UNIT}', 'σ'), 'ß', 'ss')"
    own = "o.doc_id, t.item_id, t.size, t.spot, o.begin, o.begin - t.spot as shift, t.telling, o.words, o.shape, t.item_words, t.item_shape, o.plain = t.item_plain as literal"
    figures = lambda k: f"""
        select doc_id, item_id, cast(len(list_distinct(flatten(list({k}_ats)))) as bigint) as n_matched, cast(sum(len({k}_pairs)) as bigint) as n_slots,
               cast(sum(len(list_filter({k}_pairs, lambda x: x[1] != x[2]))) as bigint) as n_changed from ways group by all"""  # noqa: E731
    enough = lambda n: f"n_matched > 0 and (100 * n_matched >= {how.share_percent} * {n} or n_matched >= {how.run - how.window + 1})"
    return f"""
    with items as ({_duck_tokens("benchmark", "item_id")}),
    sized as (select *, least({how.window}, len(shape)) as size from items),
    cut as (select item_id, spot, size, list_slice(words, spot, spot + size - 1) as item_words, list_slice(shape, spot, spot + size - 1) as item_shape
            from (select *, unnest(range(1, len(shape) - size + 2)) as spot from sized)),
    theirs as (select *, len(list_filter(item_shape, lambda x: x != '' and x not in {marks})) >= least({how.literals}, size) as telling,
                      {plain_of.format("item_words")} as item_plain
               from cut where item_shape != ['']),
    of_item as (select item_id, count(distinct spot) filter (telling) as n_telling, count(distinct spot) as n_windows from theirs group by all),
    texts as ({_duck_tokens("documents", "doc_id")}),
    ours as (select *, {plain_of.format("words")} as plain
             from (select doc_id, size, begin, list_slice(words, begin, begin + size - 1) as words, list_slice(shape, begin, begin + size - 1) as shape
                   from (select *, unnest(range(1, len(shape) - size + 2)) as begin from texts, (select distinct size from theirs)))),
    met as (select {own} from ours o join theirs t on o.plain = t.item_plain and o.size = t.size
            union select {own} from ours o join theirs t on o.shape = t.item_shape and o.size = t.size where t.telling),
    hits as (select *, telling and shape = item_shape as template,
                    list_filter(list_zip(item_words, words), lambda x: substr(x[1], 1, 1) in {marks}) as slots from met),
    along as (select doc_id, item_id, shift,
                     coalesce(list(distinct spot) filter (template), []) as template_ats, coalesce(list_distinct(flatten(list(slots) filter (template))), []) as template_pairs,
                     coalesce(list(distinct spot) filter (literal), []) as literal_ats, coalesce(list_distinct(flatten(list(slots) filter (literal))), []) as literal_pairs,
                     coalesce(list(distinct spot) filter (template and not literal), []) as changed_ats,
                     coalesce(list_distinct(flatten(list(slots) filter (template and not literal))), []) as changed_pairs
              from hits group by all),
    checked as (select *, len(template_pairs) = len(list_distinct(list_transform(template_pairs, lambda x: x[1]))) as sound,
                       len(changed_pairs) = len(list_distinct(list_transform(changed_pairs, lambda x: x[1]))) as changed_sound,
                       list_distinct(list_transform(literal_pairs, lambda x: row(x[1], x[1]))) as same from along),
    ways as (select doc_id, item_id, case when sound then template_ats else [] end as template_ats, case when sound then template_pairs else [] end as template_pairs,
                    list_distinct(list_concat(literal_ats, case when changed_sound then changed_ats else [] end)) as either_ats,
                    list_distinct(list_concat(same, case when changed_sound then list_transform(changed_pairs, lambda x: row(x[1], x[2])) else [] end)) as either_pairs
             from checked),
    by_template as (select f.*, n_telling as n from ({figures("template")}) f join of_item using (item_id) where {enough("n_telling")}),
    by_either as (select f.*, n_windows as n from ({figures("either")}) f join of_item using (item_id) where {enough("n_windows")}),
    told as (select * from by_template union all select e.* from by_either e anti join by_template t on e.doc_id = t.doc_id and e.item_id = t.item_id)
    select doc_id, item_id, n as n_windows, n_matched, n_slots, n_changed, case when n_changed > 0 then 'template' else 'verbatim' end as kind from told
    """
