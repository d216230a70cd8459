"""Benchmark decontamination by template canonicalisation.

A question that comes back with other numbers, names or units is still that question. Words are canonical:
numbers, units and names become typed placeholders, whatever number of words they have; all else is
lower-cased. Windows of canonical words of benchmark and documents meet in a hash join, and the windows that
fewest documents hold propose where an item may stand. The item is then laid along each shift there once: its
windows must stand in the text, and the slots are held against each other: one slot value in the item must
be one value in the document wherever it stands, so that a re-parameterised question passes and a chance
likeness of placeholders does not.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.session import materialize

#: Units that may change with a question's numbers, to others of their line.
UNITS = {
    "length": "mm cm m km in inch inches ft foot feet yd yard yards mile miles",
    "mass": "mg g kg t lb lbs oz pound pounds",
    "volume": "ml l litre litres liter liters",
    "time": "s sec second seconds min minute minutes h hour hours day days week weeks month months year years",
    "speed": "km/h kmh mph",
    "power": "w kw kwh j kj cal kcal v a hz pa bar",
    "money": "usd eur gbp dollar dollars euro euros cent cents",
}

#: Words that are numbers or parts of one.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()

#: Bits of the filter that a task holds of the benchmark's windows: 2 MB, whatever the benchmark's size.
FILTER_BITS = 1 << 24

#: Words of a text that are kept and moved together.
BLOCK = 1024

#: Words compared at once when an item is laid along shifts.
_CELLS = 1 << 20

NUMBER, NAME, UNIT = 1, 2, 3
_SIZE = 0x30000


def _classes() -> tuple[np.ndarray, ...]:
    """Of each code point: letter, digit, capital, end of a sentence, and its lower case."""
    letter, digit, upper = (np.zeros(_SIZE + 1, bool) for _ in range(3))
    lower = np.arange(_SIZE + 1, dtype=np.uint64)
    for i in range(_SIZE):
        c = chr(i)
        if c.isalpha():
            letter[i], upper[i] = True, c.isupper()
            if upper[i]:
                lower[i] = ord(c.lower()[0])
        elif c.isnumeric():
            digit[i] = True
        else:
            letter[i] = unicodedata.category(c)[0] == "M"
    letter[_SIZE] = True
    end = np.zeros(_SIZE + 1, bool)
    end[[ord(c) for c in ".!?\n"]] = True
    return letter, digit, upper, end, lower


def canonical(texts: list[bytes], inside: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds of the canonical words (0 or a placeholder's), hashes of what is written, and the texts' offsets among them.

    Words are runs of letters, or of digits with single points and commas between. A number is a number or a
    number word; a unit follows one; a name is a capitalised word within a sentence, unless the word before it
    is all capitals. Parted by one blank or hyphen only, names make one name, with a capitalised first word of
    the sentence before them, and a number word belongs to the number before it. ``inside`` takes texts for
    parts of a sentence: their first words can be names.
    """
    letter, digit, upper, end, lower = flat.per_process("classes", _classes)
    decoded = [t.decode() for t in texts]
    points = np.minimum(np.frombuffer(" ".join(decoded).encode("utf-32-le"), np.uint32), _SIZE)
    at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in decoded])))
    numeric = digit[points]
    middle = (points == ord(".")) | (points == ord(","))
    joint = np.zeros(len(points), bool)
    joint[1:-1] = middle[1:-1] & numeric[:-2] & numeric[2:]
    numeric |= joint
    alpha = letter[points] & ~numeric
    kind = alpha + 2 * numeric.astype(np.int8)
    begins = np.ones(len(points), bool)
    begins[1:] = kind[1:] != kind[:-1]
    ends = np.append(begins[1:], True)[: len(points)]
    starts = np.flatnonzero(begins & (kind > 0))
    stops = np.flatnonzero(ends & (kind > 0)) + 1
    offsets = np.searchsorted(starts, at)
    offsets[-1] = len(starts)
    raw = flat.stretch(flat.running(flat.mixed(lower[points] + np.uint64(1))), starts, stops)
    if not len(starts):
        return np.zeros(0, np.int8), raw, offsets
    capital = upper[points]
    capitals = np.concatenate(([0], np.cumsum(capital)))
    marks = np.concatenate(([0], np.cumsum(end[points] & ~joint)))
    leads = np.zeros(len(starts), bool)
    leads[offsets[:-1][offsets[:-1] < len(starts)]] = True
    first = np.ones(len(starts), bool)
    first[1:] = marks[starts[1:]] > marks[stops[:-1]]
    first[leads] = not inside
    shouted = (stops - starts > 1) & (capitals[stops] - capitals[starts] == stops - starts)
    spelled, units, unit_kinds = flat.per_process("fixed-words", _fixed_words)
    after = lambda x: np.concatenate(([False], x[:-1])) & ~first & ~leads
    in_words = np.isin(raw, spelled)
    number = numeric[starts] | in_words
    place = np.minimum(np.searchsorted(units, raw), len(units) - 1)
    unit = after(number) & (units[place] == raw)
    name = ~first & ~number & ~unit & capital[starts] & ~after(shouted)
    kinds = np.select([number, unit, name], [NUMBER, unit_kinds[place], NAME]).astype(np.int8)

    gap = np.zeros(len(points) + 1, bool)
    gap[:-1] = (points == ord(" ")) | (points == ord("-"))
    close = np.zeros(len(starts), bool)
    close[1:] = (starts[1:] - stops[:-1] == 1) & gap[stops[:-1]]
    opens = first & capital[starts] & ~number
    joins = close & ((name & after(name | opens)) | (in_words & after(number)))
    heads = np.flatnonzero(~joins)
    whole = flat.stretch(flat.running(raw), heads, np.append(heads[1:], len(starts)))
    return np.maximum.reduceat(kinds, heads), whole, np.concatenate(([0], np.cumsum(~joins)))[offsets]


def _hashed(words: list[str]) -> np.ndarray:
    """Hashes of words as :func:`canonical` hashes them."""
    lower = flat.per_process("classes", _classes)[4]
    points = [np.array([ord(c) for c in w], np.uint64) for w in words]
    return np.array([flat.stretch(flat.running(flat.mixed(lower[p] + np.uint64(1))), np.array([0]), np.array([len(p)]))[0] for p in points])


def _fixed_words() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number words; units, sorted, and their kinds. ``km/h`` is two words, its first one counts, as a length."""
    kinds = {u: UNIT + i for i, line in enumerate(UNITS.values()) for u in line.split() if "/" not in u}
    units = _hashed(list(kinds))
    order = np.argsort(units)
    return _hashed(NUMBER_WORDS), units[order], np.array(list(kinds.values()))[order]


def _keys(kinds: np.ndarray, raw: np.ndarray) -> np.ndarray:
    return flat.mixed(np.where(kinds > 0, kinds.astype(np.uint64), raw))


def _spread(words: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words, texts and keys of all windows within a text."""
    first = np.arange(max(0, len(words) - width + 1))
    own = np.searchsorted(offsets, first, "right") - 1
    first, own = (x[first + width <= offsets[own + 1]] for x in (first, own))
    return first, own, flat.stretch(flat.running(words), first, first + width)


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values))


_ITEM = "id long, h long, opening byte, kinds array<byte>, raw array<long>, windows array<struct<at:int,width:int,key:long>>"


def _item_rows(width: int):
    """Items as canonical words, with the kind that the first word has within a sentence, and their windows:
    ``width`` words or all of a shorter item's, the first one also as it reads within a sentence."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, at in flat.chunks(batches):
            texts = flat.pieces(body, at)
            (kinds, raw, offsets), (opening, _, _) = canonical(texts), canonical(texts, True)
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                if b - a < 4:
                    continue
                w = min(width, b - a)
                first, _, keys = _spread(_keys(kinds[a:b], raw[a:b]), np.array([0, b - a]), w)
                within = _keys(opening[a : a + w], raw[a : a + w])
                first, keys = np.append(first, 0), np.append(keys, _spread(within, np.array([0, w]), w)[2])
                windows = pa.StructArray.from_arrays(
                    [pa.array(first.astype(np.int32)), pa.array(np.full(len(first), w, np.int32)), pa.array(keys.view(np.int64))], names=["at", "width", "key"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(i, 1),
                        batch.column("h").slice(i, 1),
                        pa.array(opening[a : a + 1]),
                        _lists(kinds[a:b], np.array([0, b - a])),
                        _lists(raw[a:b].view(np.int64), np.array([0, b - a])),
                        pa.ListArray.from_arrays(pa.array([0, len(first)], pa.int32()), windows),
                    ],
                    names=["id", "h", "opening", "kinds", "raw", "windows"],
                )

    return rows


_BLOCKS = "id long, h long, block int, kinds array<byte>, raw array<long>, windows array<struct<width:int,key:long>>"


def _block_rows(widths: list[int], keep: bytes, margin: int):
    """Blocks of texts with the different windows that begin there and pass the filter, and the blocks around them."""
    bits = np.frombuffer(keep, np.uint8)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, body, at in flat.chunks(batches):
            kinds, raw, offsets = canonical(flat.pieces(body, at))
            words = _keys(kinds, raw)
            found = []
            for width in widths:
                first, own, keys = _spread(words, offsets, width)
                slot = keys & np.uint64(FILTER_BITS - 1)
                some = np.flatnonzero(bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                block = (first[some] - offsets[own[some]]) // BLOCK
                found.append(np.array([own[some], block, np.full(len(some), width), keys[some].view(np.int64)]))
            met = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
            if not met.size:
                continue
            met = met[:, np.lexsort(met[::-1])]
            met = met[:, np.append(True, (met[:, 1:] != met[:, :-1]).any(axis=0))]
            last = (np.diff(offsets) - 1) // BLOCK
            places = set(zip(met[0].tolist(), met[1].tolist(), strict=True))
            near = {(o, b) for o, c in places for b in range(max(0, c - margin), min(int(last[o]), c + margin) + 1)}
            own, block = np.array(sorted(near)).T
            begin = offsets[own] + block * BLOCK
            stop = np.minimum(begin + BLOCK, offsets[own + 1])
            cuts = np.concatenate(([0], np.cumsum(stop - begin)))
            places = np.arange(cuts[-1]) + np.repeat(begin - cuts[:-1], stop - begin)
            wide = int(last.max()) + 1
            held = np.append(np.searchsorted(met[0] * wide + met[1], own * wide + block), met.shape[1])
            windows = pa.StructArray.from_arrays([pa.array(met[2].astype(np.int32)), pa.array(met[3])], names=["width", "key"])
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(take),
                    batch.column("h").take(take),
                    pa.array(block.astype(np.int32)),
                    _lists(kinds[places], cuts),
                    _lists(raw[places].view(np.int64), cuts),
                    pa.ListArray.from_arrays(pa.array(held.astype(np.int32)), windows),
                ],
                names=["id", "h", "block", "kinds", "raw", "windows"],
            )

    return rows


def _laid(
    text: tuple[np.ndarray, np.ndarray], item: tuple[np.ndarray, np.ndarray], opening: int, first: int, block: int, width: int, coverage: float
) -> tuple[int, bool] | None:
    """Most windows of an item along one shift that begins in ``block`` with enough of them, and if they are the item's own.

    ``first`` is the number of the first word of ``text``.
    """
    n = len(item[0])
    w = min(width, n)
    n_windows = max(1, n - width + 1)
    from_, to = block * BLOCK - (n - w), block * BLOCK + BLOCK
    low, high = max(from_, first), min(to + n, first + len(text[0]))
    words, raw = np.zeros(to + n - from_, np.uint64), np.zeros(to + n - from_, np.uint64)
    there, slots = np.zeros(to + n - from_, bool), np.zeros(to + n - from_, bool)
    here = slice(low - from_, high - from_)
    words[here], raw[here], there[here] = _keys(text[0], text[1])[low - first : high - first], text[1][low - first : high - first], True
    slots[here] = text[0][low - first : high - first] > 0
    own = _keys(*item)
    other = _keys(np.array([opening], np.int8), item[1][:1])[0]
    order = np.argsort(item[1], kind="stable")
    values = item[1][order]
    groups = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    step = max(1, _CELLS // n)
    best = None
    for s in range(0, to - from_, step):
        rows = slice(s, min(s + step, to - from_))
        laid = np.lib.stride_tricks.sliding_window_view(words, n)[rows]
        same = laid == own
        same[:, 0] |= laid[:, 0] == other
        same &= np.lib.stride_tricks.sliding_window_view(there, n)[rows]
        sums = np.zeros((len(same), n + 1), np.int32)
        np.cumsum(same, axis=1, out=sums[:, 1:])
        matched = sums[:, w:] - sums[:, :-w] == w
        count = matched.sum(axis=1)
        enough = np.flatnonzero(count / n_windows >= coverage)
        if not len(enough):
            continue
        # words of windows that match
        covers = np.zeros((len(enough), n + 1), np.int32)
        covers[:, : n - w + 1] += matched[enough]
        covers[:, w:] -= matched[enough]
        covered = np.cumsum(covers, axis=1)[:, :n] > 0
        written = np.lib.stride_tricks.sliding_window_view(raw, n)[rows][enough]
        exact = ((written == item[1]) | ~covered).all(axis=1)
        # at the item's ends a name or number may go on into the text around it, so its value tells nothing
        laid_slots = np.lib.stride_tricks.sliding_window_view(slots, n)[rows][enough]
        for edge in (0, n - 1):
            covered[:, edge] &= ~laid_slots[:, edge]
        written, covered = written[:, order], covered[:, order]
        least = np.minimum.reduceat(np.where(covered, written, np.uint64(2**64 - 1)), groups, axis=1)
        most = np.maximum.reduceat(np.where(covered, written, np.uint64(0)), groups, axis=1)
        consistent = (least >= most).all(axis=1)
        for i in np.flatnonzero(exact | consistent):
            best = max(best or (0, False), (int(count[enough[i]]), bool(exact[i])))
    return best


_JUDGED = "id long, h long, item long, n_matched long, n_windows long, exact boolean"


def _judged(width: int, coverage: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            values = {c: (batch.column(c).values.to_numpy(), batch.column(c).offsets.to_numpy()) for c in ("kinds", "raw", "item_kinds", "item_raw")}
            number = {c: batch.column(c).to_pylist() for c in ("id", "h", "item", "opening", "first", "block")}
            for i in range(batch.num_rows):
                of = {c: v[at[i] : at[i + 1]] for c, (v, at) in values.items()}
                text, item = (of["kinds"], of["raw"].view(np.uint64)), (of["item_kinds"], of["item_raw"].view(np.uint64))
                best = _laid(text, item, number["opening"][i], number["first"][i], number["block"][i], width, coverage)
                if best:
                    out.append((number["id"][i], number["h"][i], number["item"][i], best[0], max(1, len(item[0]) - width + 1), best[1]))
            if out:
                types = [pa.int64()] * 5 + [pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["id", "h", "item", "n_matched", "n_windows", "exact"]
                )

    return rows


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    width: int = 8,
    coverage: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``id_col, h, item_id, n_matched, n_windows, coverage, exact``: rows of ``df`` that hold a benchmark item.

    A window is ``width`` canonical words (all of a shorter item's, from 4 on). An item is in a text when, at
    one shift, ``coverage`` or more of the item's windows stand in it with consistent slots: along that shift
    each of the item's slot values has one value in the text and each word that is no slot is the same. Slots
    at the item's two ends are not held against others: a name there may go on into the text around it.
    ``exact`` says that all slots' values are the item's own. ``h`` is the text's hash, which tells rows apart
    that share an id; rows equal in both count once. Null, empty and very short texts and items match nothing.
    Null ids and repeated items are kept apart by their texts; other columns are ignored.

    Each task first passes its windows through a filter of fixed size, so all but a few are never moved, and a
    larger benchmark costs moves, not results. An item of which ``k`` of ``n`` windows must stand in a text has
    one there among any ``n - k + 1`` of its windows; only those that fewest blocks of texts hold are looked up,
    so a window that is everywhere proposes nothing unless its item has no other. A proposal is a block of a
    text and an item, however often windows repeat in either.
    """
    if width < 4:
        raise ValueError("windows of less than 4 words are met by chance")
    if not 0 < coverage <= 1:
        raise ValueError("coverage is above 0 and at most 1")
    docs = flat.keyed_texts(df, id_col, text_col)
    items = flat.keyed_texts(benchmark, item_col, item_text_col).distinct()
    items = materialize(items.mapInArrow(_item_rows(width), _ITEM), "items")
    asked = items.select(F.col("id").alias("item"), F.col("h").alias("item_h"), F.size("raw").alias("n"), F.explode("windows").alias("w"))
    asked = asked.select("item", "item_h", "n", "w.at", "w.width", "w.key").distinct()

    # The filter: at most FILTER_BITS / 64 rows, whatever the benchmark's size.
    slot = F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    filled = asked.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    either = np.zeros(FILTER_BITS // 64, np.int64)
    either[filled.column("word").to_numpy()] = filled.column("bits").to_numpy()
    shape = asked.agg(F.collect_set("width").alias("widths"), F.max("n").alias("longest")).first()
    widths, margin = sorted(shape["widths"]), -(-(shape["longest"] or 1) // BLOCK)
    blocks = materialize(docs.mapInArrow(_block_rows(widths, either.tobytes(), margin), _BLOCKS), "blocks")

    held = blocks.select("id", "h", "block", F.explode("windows").alias("w")).select("id", "h", "block", "w.width", "w.key")
    usual = held.groupBy("width", "key").agg(F.count("*").alias("usual"))
    rare = asked.join(usual, ["width", "key"], "left").groupBy("item", "item_h", "n", "at").agg(
        F.coalesce(F.sum("usual"), F.lit(0)).alias("usual"), F.collect_set(F.struct("width", "key")).alias("keys")
    )
    n_windows = F.greatest(F.col("n") - width + 1, F.lit(1))
    spare = n_windows - F.ceil(n_windows * coverage - 1e-6) + 1
    order = F.row_number().over(Window.partitionBy("item", "item_h").orderBy("usual", "at"))
    rare = rare.withColumn("rank", order).where((F.col("rank") <= spare) & (F.col("usual") > 0))
    rare = rare.select("item", "item_h", F.explode("keys").alias("w")).select("item", "item_h", "w.width", "w.key")
    proposed = held.join(rare, ["width", "key"]).select("id", "h", "block", "item", "item_h").distinct()

    # One row per proposal: the blocks around it, as many as the longest item needs, and the item.
    around = F.explode(F.sequence(F.greatest(F.col("block") - margin, F.lit(0)), F.col("block") + margin))
    wanted = proposed.select(F.col("id").alias("i"), F.col("h").alias("g"), F.col("block").alias("of"), "item", "item_h", around.alias("b"))
    near = F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g")) & (F.col("block") == F.col("b"))
    parts = wanted.join(blocks.select("id", "h", "block", "kinds", "raw"), near)
    parts = parts.groupBy("id", "h", "of", "item", "item_h").agg(F.sort_array(F.collect_set(F.struct("block", "kinds", "raw"))).alias("parts"))
    texts = parts.select(
        "id", "h", "item", "item_h", F.col("of").alias("block"), (F.get("parts", F.lit(0))["block"] * BLOCK).alias("first"),
        F.flatten(F.transform("parts", lambda p: p["kinds"])).alias("kinds"), F.flatten(F.transform("parts", lambda p: p["raw"])).alias("raw"),
    )
    whole = items.select(F.col("id").alias("j"), F.col("h").alias("k"), "opening", F.col("kinds").alias("item_kinds"), F.col("raw").alias("item_raw"))
    pairs = texts.join(whole, F.col("item").eqNullSafe(F.col("j")) & (F.col("item_h") == F.col("k"))).drop("j", "k", "item_h")
    judged = pairs.mapInArrow(_judged(width, coverage), _JUDGED)
    share = (F.col("n_matched") / F.col("n_windows")).alias("coverage")
    best = judged.groupBy("id", "h", "item").agg(F.max(F.struct(share, "exact", "n_matched", "n_windows")).alias("m"))
    return best.select(F.col("id").alias(id_col), "h", F.col("item").alias("item_id"), "m.n_matched", "m.n_windows", "m.coverage", "m.exact")


def drop_contaminated(df: DataFrame, benchmark: DataFrame, width: int = 8, coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows that hold a benchmark item, as :func:`contaminated` finds them."""
    bad = contaminated(df, benchmark, width, coverage, id_col, text_col).select(id_col, "h").distinct()
    id_, h = flat.fresh(df, "id", "h")
    bad = materialize(bad, "contaminated").toDF(id_, h)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(h))
    return df.join(bad, same, "left_anti")
