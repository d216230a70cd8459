"""Secret scans: known shapes, and tokens that a battery of randomness tests tells from ordinary strings.

All of it is column expressions. Known shapes are found by their patterns. Every other run of key characters
is a candidate; its encoding is read off its characters, and three tests ask whether it may be random in that
encoding: chi-squared for a uniform alphabet, runs above and below the alphabet's middle, and the serial
correlation of neighbours. A short ordinary string can pass all three. So each candidate is also held against
the hypothesis that it is ordinary: repeats of characters as frequent as in the corpus's own tokens of that
encoding that the battery refused make its chi-squared a non-central one, whose centre grows with the length. False discoveries are
controlled over these p-values by Benjamini and Hochberg's rule in each band of lengths, as short candidates
are many and weak, long ones few and strong.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import flat
from millrace.llm.let import let
from millrace.operators.columns import quoted
from millrace.session import materialize

#: What a known secret looks like, and the least length of the part that counts.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_HEAD = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN_LENGTH = 8
#: A longer run holds all shorter ones from the same place, so these need no later check of the length.
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"

KINDS = ("assign", "access", "hex", "random")

#: Encodings by the characters they use, narrowest first, and the alphabet's order.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + _LOWER[:6],
    "hex_upper": _DIGITS + _UPPER[:6],
    "base32": _UPPER + _DIGITS[2:8],
    "lower36": _DIGITS + _LOWER,
    "upper36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "mixed": _UPPER + _LOWER + _DIGITS + "+/-_",
}
#: Before the corpus has been seen, as if from so many pairs of characters: equal ones among ordinary tokens,
#: as in prose, but half as many again as in a uniform alphabet at least.
PRIOR_PAIRS, PRIOR_EQUAL, PRIOR_EXCESS = 1000.0, 0.06, 1.5

#: Lengths of a band: from a power of the square root of two to the next.
_BANDS_PER_DOUBLING = 2
#: p-values are sorted by steps of a twentieth of a power of ten, down to 10^-40.
_STEPS, _LAST_STEP = 20, 800
_BLOCK = 256
_STRETCH = 4096


def before(lengths: Column) -> Column:
    """Sums of all earlier elements, by blocks: an array that grows by one in each step would be copied as often."""

    def sums(xs: Column) -> Column:
        def add(done: Column, x: Column) -> Column:
            return F.struct(F.concat(done["out"], F.array(done["total"])).alias("out"), (done["total"] + x).alias("total"))

        start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(xs, start, add, lambda s: s["out"])

    def whole(xs: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(xs) - 1, F.lit(0)), F.lit(_BLOCK)), lambda i: i < F.size(xs))
        blocks = F.transform(starts, lambda i: F.slice(xs, i + 1, F.lit(_BLOCK)))

        def joined(parts: Column) -> Column:
            totals = F.transform(parts, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x))
            return let(sums(totals), lambda off: F.flatten(F.zip_with(parts, off, lambda b, o: F.transform(sums(b), lambda s: s + o))))

        return let(blocks, joined)

    return let(lengths, whole)


def matches(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches as ``kind, start, end, value``: places count code points from 0."""
    found = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"))

    def placed(f: Column) -> Column:
        pairs = F.zip_with(F.slice(f["gaps"], F.lit(1), F.size(f["values"])), f["values"], lambda g, v: F.struct(F.char_length(g).cast("long").alias("g"), F.char_length(v).cast("long").alias("v")))

        def spans(p: Column) -> Column:
            starts = before(F.transform(p, lambda x: x["g"] + x["v"]))
            with_values = F.arrays_zip(p.alias("p"), f["values"].alias("value"), starts.alias("at"))
            return F.transform(
                with_values,
                lambda x: F.struct(
                    F.lit(kind).alias("kind"),
                    (x["at"] + x["p"]["g"]).alias("start"),
                    (x["at"] + x["p"]["g"] + x["p"]["v"]).alias("end"),
                    x["value"].alias("value"),
                ),
            )

        return let(pairs, spans)

    return let(found, placed)


_SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def _none() -> Column:
    return F.array().cast(_SPANS)


def outside(tokens: Column, spans: Column, length: Column) -> Column:
    """The tokens that no span meets; either is looked up by the stretches of text it touches, not all by all."""
    last = F.floor(F.coalesce(length, F.lit(0)) / _STRETCH).cast("int")
    stretches = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.filter(spans, lambda b: (b["end"] > i * _STRETCH) & (b["start"] < (i + 1) * _STRETCH))
    )

    def free(by: Column) -> Column:
        def met(t: Column) -> Column:
            first = F.floor(t["start"] / _STRETCH).cast("int")
            touched = F.slice(by, first + 1, F.floor((t["end"] - 1) / _STRETCH).cast("int") - first + 1)
            return F.exists(touched, lambda here: F.exists(here, lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])))

        return F.filter(tokens, lambda t: ~met(t))

    return F.when((F.size(tokens) == 0) | (F.size(spans) == 0), tokens).otherwise(let(stretches, free))


def encoding_of(token: Column) -> Column:
    out = None
    for name, alphabet in ENCODINGS.items():
        fits = token.rlike("^[" + alphabet.replace("-", r"\-") + "]+$")
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out


def upper_tail(z: Column) -> Column:
    """P(Z > z) for a standard normal Z, by a rational approximation that is right to seven digits."""

    def of(x: Column) -> Column:
        t = 1 / (1 + 0.2316419 * F.abs(x))
        tail = F.exp(-x * x / 2) / 2.5066282746310002 * let(t, lambda t: t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))))
        return let(tail, lambda p: F.when(x >= 0, p).otherwise(1 - p))

    return let(z, of)


def _walked(at: Column, k: Column) -> Column:
    """One pass over the letters' places: runs above and below the middle, sums and products of neighbours."""
    start = F.struct(
        F.lit(-1).alias("last"), F.lit(0).alias("runs"), F.lit(0).alias("high"),
        F.lit(0.0).alias("s"), F.lit(0.0).alias("ss"), F.lit(0.0).alias("cross"),
    )

    def step(a: Column, i: Column) -> Column:
        same = (a["last"] >= 0) & ((a["last"] * 2 < k) == (i * 2 < k))
        return F.struct(
            i.alias("last"),
            (a["runs"] + F.when(same, 0).otherwise(1)).alias("runs"),
            (a["high"] + F.when(i * 2 < k, 0).otherwise(1)).alias("high"),
            (a["s"] + i).alias("s"),
            (a["ss"] + i * i).alias("ss"),
            (a["cross"] + F.when(a["last"] >= 0, a["last"] * i).otherwise(0)).alias("cross"),
        )

    return F.aggregate(at, start, step)


def _p_random(n: Column, k: Column, square: Column, first: Column, w: Column) -> Column:
    """How well a token fits a uniform alphabet, runs and neighbours of a random one: all three by Fisher's rule."""
    free = k - 1
    # Wilson and Hilferty's cube root makes chi-squared normal.
    z_chi = (F.pow(F.greatest(square * k / n - n, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    high = w["high"].cast("double")

    def runs(m: Column) -> Column:
        spread = (m - 1) * (m - 2) / (n - 1)
        return F.when(spread > 0, (w["runs"] - m) / F.sqrt(spread)).otherwise(40.0)

    z_runs = let(2 * high * (n - high) / n + 1, runs)
    # The last letter meets the first, so that all places count alike.
    both = F.struct((w["s"] * w["s"] / n).alias("mean"), (w["ss"] - w["s"] * w["s"] / n).alias("scatter"))
    z_serial = let(
        both,
        lambda b: F.when(b["scatter"] > 0, ((w["cross"] + w["last"] * first - b["mean"]) / b["scatter"] + 1 / (n - 1)) * F.sqrt(n - 1)).otherwise(40.0),
    )
    ps = (upper_tail(z_chi), 2 * upper_tail(F.abs(z_runs)), 2 * upper_tail(F.abs(z_serial)))
    logs = [F.log(F.greatest(p, F.lit(1e-300))) for p in ps]
    # Half the chi-squared of 6 degrees of freedom.
    return let(-(logs[0] + logs[1] + logs[2]), lambda f: F.exp(-f) * (1 + f + f * f / 2))


def _by_name(values: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)


def _battery(token: Column) -> Column:
    """``encoding, n, k, square, p_random`` of a token: ``square`` is the sum of its letters' squared counts."""

    def prepared(encoding: Column) -> Column:
        def counted(letters: Column) -> Column:
            counts = F.transform(F.split(letters, ""), lambda c: (F.length(token) - F.length(F.replace(token, c, F.lit("")))).cast("long"))
            return F.struct(
                F.length(letters).alias("k"),
                F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c * c).alias("square"),
                F.transform(F.split(token, ""), lambda c: F.instr(letters, c) - 1).alias("at"),
            )

        def tested(x: Column) -> Column:
            n, k = F.length(token), x["k"]
            p = let(_walked(x["at"], k), lambda w: _p_random(n.cast("double"), k.cast("double"), x["square"], x["at"][0], w))
            return F.struct(encoding.alias("encoding"), n.cast("long").alias("n"), k.alias("k"), x["square"].alias("square"), p.alias("p_random"))

        return let(let(_by_name(ENCODINGS, encoding), counted), tested)

    return let(encoding_of(token), prepared)


def _ordinary(token: Column, excess: dict[str, float]) -> Column:
    """P-value of a token as an ordinary string: its chi-squared is at most this by chance.

    ``excess`` has, by encoding, how much more often than by chance two characters of an ordinary token are
    equal. Sankaran's power transform makes a non-central chi-squared normal.
    """
    n, k = token["n"].cast("double"), token["k"].cast("double")
    sizes = F.struct((k - 1).alias("free"), ((n - 1) * (_by_name(excess, token["encoding"]) - 1)).alias("off"))

    def powers(x: Column) -> Column:
        free, off = x["free"], x["off"]
        h = 1 - 2 * (free + off) * (free + 3 * off) / (3 * (free + 2 * off) * (free + 2 * off))
        return F.struct(h.alias("h"), ((free + 2 * off) / ((free + off) * (free + off))).alias("p"), (free + off).alias("centre"))

    def standard(x: Column) -> Column:
        h, p = x["h"], x["p"]
        m = (h - 1) * (1 - 3 * h)
        mean = 1 + h * p * (h - 1 - (2 - h) * m * p / 2)
        spread = h * F.sqrt(2 * p) * (1 + m * p / 2)
        return (F.pow(F.greatest(token["square"] * k / n - n, F.lit(0.0)) / x["centre"], h) - mean) / spread

    return upper_tail(-let(let(sizes, powers), standard))


def _step(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * _STEPS), F.lit(_LAST_STEP)).cast("int")


def _by_band(limits: dict[int, int], n: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in (limits or {-1: 0}).items() for x in kv]), _band(n))


def _band(n: Column) -> Column:
    return F.floor(F.log2(n.cast("double")) * _BANDS_PER_DOUBLING).cast("int")


def secrets(df: DataFrame, min_length: int = 20, alpha: float = 0.01, q: float = 0.01, text_col: str = "text") -> DataFrame:
    """``df`` with ``spans`` (replacing a column of that name): ``kind, start, end`` of each secret in the text.

    Places are code points from 0, ``end`` exclusive; order is by start, then by kind as in ``KINDS``. The
    kinds ``assign``, ``access`` and ``hex`` are whole matches of known shapes, leftmost and not overlapping
    among a kind. ``random`` is a run of ``[A-Za-z0-9+/_=-]`` outside those, of ``min_length`` or more characters
    less padding, that its encoding's battery does not refuse at ``alpha`` and that is no ordinary string at
    false-discovery rate ``q`` among all candidates of its band of lengths.

    Null and empty texts have no spans. Texts and tokens are taken whole, whatever their length. Repeated rows
    are rows of their own, and each counts among the candidates. The rates and the bands' limits come from all
    rows, so a text's ``random`` spans depend on the table it stands in; an empty table has none.

    Nothing but counts is moved: repeats by encoding, candidates by band and step of p.
    """
    if min_length < 8:
        raise ValueError("shorter tokens tell the tests nothing")
    text, base, tokens, tested = flat.fresh(df, "text", "base", "tokens", "tested")
    whole = df.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    # One search of the whole text decides most: all but assignments lie in long runs of key characters.
    run = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{min(min_length, 16)},}}+"
    runs = F.when(F.col(text).rlike(run), matches(F.col(text), run, "random")).otherwise(_none())
    assigned = F.when(F.col(text).rlike("(?i:passw|secret|token|api_?key)"), F.filter(matches(F.col(text), ASSIGN, "assign"), lambda m: F.length(F.regexp_replace(m["value"], ASSIGN_HEAD, "")) >= ASSIGN_LENGTH)).otherwise(_none())
    access = F.when(F.col(text).contains("AKIA"), matches(F.col(text), ACCESS, "access")).otherwise(_none())
    hexes = F.when(F.col(text).rlike(HEX), matches(F.col(text), HEX, "hex")).otherwise(_none())
    rest = df.columns
    found = whole.select(*(quoted(c) for c in rest), F.concat(assigned, access, hexes).alias(base), runs.alias(tokens))

    def judged(t: Column) -> Column:
        token = F.regexp_replace(t["value"], "=+$", "")
        return let(token, lambda v: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when((F.length(v) >= min_length) & ~v.contains("="), _battery(v)).alias("test")))

    long = F.filter(tokens, lambda t: t["end"] - t["start"] >= min_length)
    clear = F.filter(F.transform(outside(long, F.col(base), F.char_length(quoted(text_col))), judged), lambda t: t["test"].isNotNull())
    bare = F.transform(base, lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    found = materialize(found.select(*(quoted(c) for c in rest), bare.alias(base), clear.alias(tested)), "candidates")

    # Ten encodings, and at most _LAST_STEP steps in each of fewer than 64 bands, come to the driver.
    each = found.select(F.explode(tested).alias("t")).select("t.test.*")
    pairs = F.col("n").cast("double") * (F.col("n") - 1)
    refused = each.where(F.col("p_random") < alpha)
    repeats = refused.groupBy("encoding").agg(F.sum(F.col("square") - F.col("n")).cast("double").alias("same"), F.sum(pairs).alias("pairs"))
    excess = {name: max(PRIOR_EXCESS, PRIOR_EQUAL * len(letters)) for name, letters in ENCODINGS.items()}
    for r in repeats.collect():
        seen = r.same * len(ENCODINGS[r.encoding])
        excess[r.encoding] = max(1.0, (seen + PRIOR_PAIRS * excess[r.encoding]) / (r.pairs + PRIOR_PAIRS))
    steps = each.select(_band(F.col("n")).alias("band"), _step(_ordinary(F.struct("encoding", "n", "k", "square"), excess)).alias("step"))
    counts = steps.groupBy("band", "step").agg(F.count("*").alias("here"))
    smaller = Window.partitionBy("band").orderBy(F.desc("step"))
    ranked = counts.select("band", "step", F.sum("here").over(smaller).alias("found"), F.sum("here").over(Window.partitionBy("band")).alias("all"))
    # A step's largest p-value stands for all of it.
    passed = ranked.where(F.pow(F.lit(10.0), -F.col("step") / float(_STEPS)) * F.col("all") <= q * F.col("found"))
    limits = {r.band: r.step for r in passed.groupBy("band").agg(F.min("step").alias("step")).collect()}

    def discovered(t: Column) -> Column:
        bound = F.coalesce(_by_band(limits, t["test"]["n"]), F.lit(_LAST_STEP + 1))
        return (t["test"]["p_random"] >= alpha) & (_step(_ordinary(t["test"], excess)) >= bound)

    random = F.transform(F.filter(tested, discovered), lambda t: F.struct(F.lit("random").alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    place = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    ordered = F.array_sort(F.transform(F.concat(base, random), lambda s: F.struct(s["start"].alias("start"), F.element_at(place, s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))))
    out = F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    kept = [c for c in rest if c.lower() != "spans"]
    return found.select(*(quoted(c) for c in kept), out.alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
