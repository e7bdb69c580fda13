"""Benchmark decontamination by canonical templates.

Numbers, units after numbers, and names (capitalised words inside a sentence) become typed
placeholders, one token each. Other capitalised words, as at the start of a sentence, may be names or
not: windows over them are hashed in both ways. Windows of canonical tokens of the documents are hash-joined
with those of the benchmark items; so a question is found again although its numbers and
names were exchanged. Windows are added up over neighbouring shifts (document position minus
item position), so words put in or taken out do not split a copy; a name of several words is one
placeholder. A find counts by the windows whose slots are consistent along one alignment: the same
value of the item always stands for the same value of the document, and for names the other way
round too (two numbers or units may become equal by chance). Values that differ are decided by the
majority. Windows whose slots are all literally equal count without that. Of the alignments of an item with a
document, the one of most windows is scored first; then only those are that hold more windows than it has in the end, so
a repetitive text, which fits a repetitive item at thousands of places, is not scored at each.

Only DataFrame functions are used. The benchmark's windows are broadcast up to
``BROADCAST_WINDOWS`` rows of three numbers, beyond that the join is shuffled; texts are
not carried through it. Of the documents that hold enough windows, up to ``BROADCAST_ROWS`` row numbers are broadcast
and their tokens staged, so only texts that are scored are shuffled; of more documents, all texts are, once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmill.llm.common import ROW, pack, unpack
from segmill.operators.staging import stage

WINDOW = 8
#: Share of an item's windows that a document must hold along one alignment.
COVERAGE = 0.5
#: A window needs this many tokens that are not placeholders.
LEAST_PLAIN = 3
BROADCAST_WINDOWS = 200_000
BROADCAST_ROWS = 2_000_000
#: Shifts are added up over the length of the item, and at least over this many.
LEAST_REACH = 16
RESULTS = ["item_id", "n_windows", "item_windows", "coverage", "n_slots", "n_changed"]

# Placeholders (characters that no token pattern takes) and the units known, in plain text.
NUMBER, UNIT, NAME = "ⓝ", "ⓤ", "ⓟ"
#: Stands before a capitalised word that may be a name.
MAYBE = "ⓠ"
UNITS = (
    "mm cm dm m km mg g kg t ml cl l kmh mph hz khz mhz ghz kb mb gb tb w kw mw v a j kj "
    "inch inches foot feet yard yards mile miles ounce ounces pound pounds ton tons gallon gallons litre litres liter liters "
    "meter meters metre metres gram grams kilogram kilograms kilometer kilometers kilometre kilometres "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros percent degree degrees"
).split()

# Groups that repeat are possessive: by a backtracking one, Java recurses at every repetition, and a run of thousands overflows its stack.
_VALUE = r"\p{N}+(?:[.,:/]\p{N}+)*+"
_LETTERS = r"\p{L}[\p{L}\p{M}]*"
_NAME = r"(?=\p{Lu})(?<=[\p{Ll}\p{M},;:] )\p{Lu}[\p{L}\p{M}]*(?: \p{Lu}[\p{L}\p{M}]*)*+"
_FIRST = r"(?=\p{Lu})(?<![\p{L}\p{M}])(\p{Lu}[\p{L}\p{M}]*)"
_SPACE = r"[\s\p{Z}&&[^ ]][\s\p{Z}]*| [\s\p{Z}]+"


def _flat(text: Column) -> Column:
    """The text with one space for any white space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, " ")


def raw_tokens(text: Column) -> Column:
    """Names, numbers and words as they stand, position by position those of ``canonical_tokens``."""
    return F.regexp_extract_all(_flat(text), F.lit(f"{_NAME}|{_VALUE}|{_LETTERS}"), F.lit(0))


def canonical_tokens(text: Column) -> Column:
    """Lower-case words with placeholders for names, numbers and units; those that may be names begin with ``MAYBE``."""
    named = F.regexp_replace(F.regexp_replace(_flat(text), _NAME, NAME), _FIRST, f"{MAYBE}$1")
    numbered = F.regexp_replace(named, _VALUE, f" {NUMBER} ")
    lower = F.regexp_replace(F.lower(numbered), f"{NUMBER} {{1,3}}{MAYBE}?(?:{'|'.join(UNITS)})(?![\\p{{L}}\\p{{M}}])", f"{NUMBER} {UNIT}")
    return F.regexp_extract_all(lower, F.lit(f"[{NUMBER}{UNIT}{NAME}]|{MAYBE}?{_LETTERS}"), F.lit(0))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not for every element of a lambda."""
    return F.transform(F.array(value), use)[0]


def _windows(texts: DataFrame, widths: list[int], plain: bool = False) -> DataFrame:
    """``texts`` with ``width, at, hash`` of every run of tokens of the ``widths``, and once more with names where words may be names, for its ``tokens``.

    Shorter texts have none. With ``plain``, runs that hold too few tokens that are not placeholders are left out.
    """
    least, most = min(widths), max(widths)
    starts = F.greatest(F.size("tokens") - (least - 1), F.lit(0))
    # The tokens from every start on side by side, null behind the last one: generated code hashes these, while it calls a lambda for every window.
    runs = F.arrays_zip(*[F.slice("tokens", F.lit(i + 1), starts) for i in range(most)])
    other = [c for c in texts.columns if c != "tokens"]
    tokens = [F.col("run").getField(str(i)) for i in range(most)]
    maybe = [t.startswith(MAYBE) for t in tokens]
    words = [F.when(m, F.substr(t, F.lit(2))).otherwise(t) for m, t in zip(maybe, tokens, strict=True)]
    names = [F.when(m, F.lit(NAME)).otherwise(t) for m, t in zip(maybe, tokens, strict=True)]

    def hashed(reading: list[Column], width: int, *wanted: Column) -> Column:
        if width > least:
            wanted += (tokens[width - 1].isNotNull(),)
        if plain:
            wanted += (reduce(Column.__add__, [(~t.isin(NUMBER, UNIT, NAME)).cast("int") for t in reading[:width]]) >= min(LEAST_PLAIN, width),)
        value = F.xxhash64(*reading[:width])
        return F.struct(F.lit(width).alias("width"), (F.when(reduce(Column.__and__, wanted), value) if wanted else value).alias("hash"))

    windows = [h for w in widths for h in (hashed(words, w), hashed(names, w, reduce(Column.__or__, maybe[:w])))]
    found = texts.select(*other, F.posexplode(runs).alias("at", "run")).select(*other, "at", F.explode(F.array(*windows)).alias("window"))
    return found.select(*other, "window.width", "at", "window.hash").where("hash is not null")


def _first_of_each_start(lines: Column) -> Column:
    """One (item_at, shift) for every ``item_at`` of the lines (n, shift, starts): that of the longest line, then of the smallest shift.

    Lines that follow once all ``item_windows`` are met add nothing.
    """
    ordered = F.array_sort(F.transform(lines, lambda l: F.struct(F.negative(l["n"]).alias("n"), l["shift"].alias("shift"), l["starts"].alias("starts"))))
    none = F.struct(F.array().cast("array<int>").alias("starts"), F.array().cast("array<struct<item_at:int,shift:int>>").alias("met"))

    def added(seen: Column, line: Column) -> Column:
        new = F.transform(F.array_except(line["starts"], seen["starts"]), lambda s: F.struct(s.alias("item_at"), line["shift"].alias("shift")))
        more = F.struct(F.array_union(seen["starts"], line["starts"]).alias("starts"), F.concat(seen["met"], new).alias("met"))
        return F.when(F.size(seen["starts"]) < F.col("item_windows"), more).otherwise(seen)

    alone = _once(lines[0], lambda l: F.transform(l["starts"], lambda s: F.struct(s.alias("item_at"), l["shift"].alias("shift"))))
    return F.when(F.size(lines) == 1, alone).otherwise(F.aggregate(ordered, none, added)["met"])


def _pair(slot: Column) -> Column:
    return F.struct(slot["kind"].alias("kind"), slot["here"].alias("here"), slot["there"].alias("there"))


def _rank(vote: Column) -> Column:
    pair = vote["pair"]
    return F.struct(vote["n"].alias("n"), (pair["here"] == pair["there"]).alias("same"), pair.alias("pair"))


def _partners(pairs: Column) -> Column:
    """The consistent ones of the pairs (kind, here, there): every value with the partner it has most often, itself if in doubt.

    A value of the item has one partner; a name of the document too.
    """

    def beaten(vote: Column, votes: Column, side: str) -> Column:
        mine = vote["pair"]
        return F.exists(votes, lambda v: (v["pair"]["kind"] == mine["kind"]) & (v["pair"][side] == mine[side]) & (_rank(v) > _rank(vote)))

    votes = _once(
        pairs, lambda ps: F.transform(F.array_distinct(ps), lambda p: F.struct(p.alias("pair"), F.size(F.filter(ps, lambda q: q == p)).alias("n")))
    )
    one = _once(votes, lambda vs: F.filter(vs, lambda v: ~beaten(v, vs, "here")))
    left = _once(one, lambda vs: F.filter(vs, lambda v: (v["pair"]["kind"] != NAME) | ~beaten(v, vs, "there")))
    return F.transform(left, lambda v: v["pair"])


def _without(slots: Column) -> Column:
    """The windows ``met`` that hold none of the slots."""
    inside = lambda c, w: (c["shift"] == w["shift"]) & c["at"].between(w["item_at"], w["item_at"] + F.col("width") - 1)
    return _once(slots, lambda cs: F.filter("met", lambda w: ~F.exists(cs, lambda c: inside(c, w))))


def _no_leaks(rows: DataFrame, items: DataFrame) -> DataFrame:
    long = F.lit(0).cast("long")
    none = rows.where(F.lit(False)).select("row_no", F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"))
    return none.select("*", *[(long if name != "coverage" else F.lit(0.0)).alias(name) for name in RESULTS[1:]])


def _values(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """The raw tokens of every row that has lines, staged."""
    wanted = lines.select("row_no").distinct()
    few = wanted.count() <= BROADCAST_ROWS
    found = rows.select("row_no", "text").join(F.broadcast(wanted) if few else wanted, "row_no", "left_semi")
    return stage(found.select("row_no", raw_tokens(F.col("text")).alias("doc_raw")), "leak-values")


def _scored(lines: DataFrame, items: DataFrame, values: DataFrame) -> DataFrame:
    """Windows and slots of the alignments ``lines`` (row_no, item_no, width, item_windows, part, met); ``values`` as of ``_values``."""

    def positions(window: Column) -> Column:
        return F.transform(
            F.sequence(window["item_at"], window["item_at"] + F.col("width") - 1),
            lambda at: F.struct(at.alias("at"), window["shift"].alias("shift")),
        )

    slots = (
        lines.join(items, "item_no")
        .join(values, "row_no")
        .withColumn("covered", F.array_distinct(F.flatten(F.transform("met", positions))))
        .withColumn(
            "slots",
            F.transform(
                "covered",
                lambda c: F.struct(
                    c["at"].alias("at"),
                    c["shift"].alias("shift"),
                    F.when(F.get("tokens", c["at"]).startswith(MAYBE), F.lit(NAME)).otherwise(F.get("tokens", c["at"])).alias("kind"),
                    F.lower(F.get("raw", c["at"])).alias("here"),
                    F.lower(F.get("doc_raw", c["at"] + c["shift"])).alias("there"),
                ),
            ),
        )
        # Words that were met as words are no slots.
        .withColumn("slots", F.filter("slots", lambda c: F.get("tokens", c["at"]).isin(NUMBER, UNIT, NAME) | (c["here"] != c["there"])))
    )
    pairs = F.transform("slots", _pair)
    literal = _without(F.filter("slots", lambda c: c["here"] != c["there"]))
    consistent = _without(_once(_partners(pairs), lambda ps: F.filter("slots", lambda c: ~F.array_contains(ps, _pair(c)))))
    slots = slots.withColumn("n_windows", F.greatest(F.size(literal), F.size(consistent)))
    return slots.select(
        "row_no",
        "item_no",
        "part",
        F.size("met").alias("n_met"),
        "item_id",
        F.col("n_windows").cast("long"),
        F.col("item_windows").cast("long"),
        (F.col("n_windows") / F.col("item_windows")).alias("coverage"),
        F.size(F.array_distinct("slots.at")).cast("long").alias("n_slots"),
        F.size(F.filter("slots", lambda c: c["here"] != c["there"])).cast("long").alias("n_changed"),
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    width: int = WINDOW,
    coverage: float = COVERAGE,
) -> tuple[DataFrame, DataFrame]:
    """The documents (columns ``keep``, all by default, packed with ``row_no``), and the leaks among them.

    A leak is a row ``row_no, item_id, n_windows, item_windows, coverage, n_slots, n_changed``: along its
    best alignment the document holds at least ``coverage`` of the item's usable windows with consistent,
    or with literally equal, slots. An alignment is one shift, or all shifts that differ by less than the
    item's length (any two that differ by half of it are in one). ``n_changed`` of the ``n_slots`` slots in all windows met differ in value (after case), so 0 means a literal
    copy. Items of fewer than ``width`` tokens are matched as one window of their own
    length, from three tokens on; items without a usable window, null items and null
    texts match nothing. Repeated items and rows are each reported; an empty table on either side gives no leaks.
    Kept columns travel packed, so their names clash with nothing.
    """
    keep = docs.columns if keep is None else keep
    source = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    packed = stage(pack(source, row_no=F.monotonically_increasing_id()), "leak-rows")
    rows = packed.select(
        F.struct(*[F.col(ROW).getField(c).alias(c) for c in keep]).alias(ROW), "row_no", F.col(ROW).getField(text).alias("text")
    )
    items = benchmark.select(benchmark[f"`{item}`"].alias("item_id"), benchmark[f"`{item_text}`"].alias("item_text")).select(
        "item_id",
        F.monotonically_increasing_id().alias("item_no"),
        canonical_tokens(F.col("item_text")).alias("tokens"),
        raw_tokens(F.col("item_text")).alias("raw"),
    )
    items = stage(items.where(F.size("tokens") >= min(3, width)).withColumn("width", F.least(F.size("tokens"), F.lit(width))), "leak-items")
    widths = [w for (w,) in items.select("width").distinct().orderBy("width").collect()]  # at most `width` values
    if not widths:
        return rows.select(ROW, "row_no"), _no_leaks(rows, items)
    keys = [_windows(items.where(F.col("width") == w).select("item_no", "tokens"), [w], plain=True) for w in widths]
    keys = stage(reduce(DataFrame.union, keys).select("hash", "width", "item_no", F.col("at").alias("item_at")), "leak-keys")
    usable_windows = keys.groupBy("item_no").agg(F.countDistinct("item_at").cast("int").alias("item_windows"))
    tokens = rows.select("row_no", canonical_tokens(F.col("text")).alias("tokens"))
    windows = _windows(tokens, widths)
    small = keys.count() <= BROADCAST_WINDOWS
    # The hash is over all tokens of a window, so windows of different widths only meet by a collision; the width is compared as well.
    if len(widths) == 1:
        windows, on = windows.drop("width"), ["hash"]  # one long is looked up faster
    else:
        on = ["hash", "width"]
    found = windows.join(F.broadcast(keys) if small else keys, on).select("row_no", "item_no", "at", "item_at", "width")
    shift = (F.col("at") - F.col("item_at")).alias("shift")
    lines = found.groupBy("row_no", "item_no", "width", shift).agg(F.collect_set("item_at").alias("starts"))
    usable = items.select("item_no", "item_id", "tokens", "raw").join(usable_windows, "item_no")
    lines = lines.join(usable.select("item_no", "item_windows", F.greatest(F.size("tokens"), F.lit(LEAST_REACH)).alias("reach")), "item_no")
    # Every shift alone, and twice in stretches of the item's length, half a length apart.
    places = [F.col("shift").cast("long"), F.floor(F.col("shift") / F.col("reach")), F.floor(F.col("shift") / F.col("reach") + 0.5)]
    kinds = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), place.alias("place")) for kind, place in enumerate(places)])).alias("part")
    line = F.struct(F.size("starts").alias("n"), "shift", "starts")
    lines = (
        lines.select("row_no", "item_no", "width", "item_windows", line.alias("line"), kinds)
        .groupBy("row_no", "item_no", "width", "item_windows", "part")
        .agg(F.collect_list("line").alias("lines"))
        .where((F.col("part.kind") == 0) | (F.size("lines") > 1))
        .where(F.aggregate("lines", F.lit(0), lambda n, l: n + l["n"]) >= coverage * F.col("item_windows"))
        .select("row_no", "item_no", "width", "item_windows", "part", _first_of_each_start(F.col("lines")).alias("met"))
        .where(F.size("met") >= coverage * F.col("item_windows"))
    )
    lines = stage(lines, "leak-lines")
    texts, values = usable.select("item_no", "item_id", "tokens", "raw"), _values(lines, rows)
    pair = ["row_no", "item_no"]
    firsts = lines.groupBy(*pair).agg(F.min(F.struct(F.negative(F.size("met")).alias("n"), "part"))["part"].alias("part"))
    first = stage(_scored(lines.join(firsts, [*pair, "part"]), texts, values), "leak-firsts")
    more = lines.join(first.select(*pair, F.col("n_windows").alias("sure")), pair).where(F.size("met") > F.col("sure")).drop("sure")
    best = Window.partitionBy(*pair).orderBy(F.desc("n_windows"), F.desc("n_met"), "part")
    leaks = (
        first.union(_scored(more, texts, values))
        .where(F.col("n_windows") >= coverage * F.col("item_windows"))
        .withColumn("place", F.row_number().over(best))
        .where("place = 1")
        .select("row_no", *RESULTS)
    )
    return rows.select(ROW, "row_no"), leaks


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, with their columns."""
    rows, leaks = find_leaks(docs, benchmark)
    return unpack(rows.join(leaks.select("row_no").distinct(), "row_no", "left_anti"))
