"""Personal data: spans by rule, and further spans that boosted trees select from candidates.

Everything is a Spark SQL expression over one row, so nothing is shuffled and no Python runs on the
executors. The rules give the base spans. Generators with far looser patterns propose candidates, which may
overlap: spelt-out and spaced-out forms, and also prose, version numbers and other digits that only look like
them. A candidate that a rule agrees with teaches its kind, one that belongs to another kind or is not sound
teaches the contrary, and the trees decide about the rest by format and surroundings: gradient-boosted trees for
each kind, fitted on the candidates of half of all rows, with a threshold per kind set on those of the other half.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shared import keep

KINDS = ("email", "ip", "card", "phone")
_SPAN = "array<struct<k: int, s: int, e: int, x: string>>"
_CHUNK = 1024  # characters of the pieces in which a text is looked up

#: The rules. Each finds the same matches as the plain pattern in its comment, in one pass over the
#: text: quantifiers do not give back, and a match starts where a run of its characters starts.
BASE = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ with 13 to 19 digits: longer and shorter chains fail, so they are not matched
    r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    r"\+[0-9][ ().0-9-]+[0-9]",
)
#: The generators.
LOOSE = (
    # with (at), [at], at, @ with spaces; with (dot), [dot], dot, and dots that end a sentence
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[(\[]at[)\]] ?| ?@ ?| at )[A-Za-z0-9-]{1,63}+(?:(?: ?[(\[]dot[)\]] ?| dot |\. ?)[A-Za-z0-9-]{1,63}+){1,8}+",
    # two to six numbers with dots, and addresses in eight hexadecimal groups or fewer with ::
    r"(?<![0-9A-Za-z.:])(?:[0-9]{1,5}+(?: ?\. ?[0-9]{1,5}+){1,5}+|[0-9A-Fa-f]{1,4}+(?::{1,2}[0-9A-Fa-f]{1,4}+){2,7}+)(?![0-9A-Za-z:])",
    # twelve to twenty-two digits, alone or with separators
    r"(?<![0-9A-Za-z])[0-9](?:[ ./_-]{0,2}[0-9]){11,21}+(?![0-9A-Za-z])",
    # three to five groups of digits, with and without brackets and country code
    r"(?<![0-9A-Za-z])[(+]?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9A-Za-z])",
)
#: Words before a candidate that speak of its kind.
CUES = ("mail|contact|write|kontakt|correo|courriel", "ip|host|server|addr", "card|visa|karte|tarjeta|carte|pay", "tel|phone|call|fax|mobil|cell")
#: Features of a candidate, all whole numbers.
FEATURES = ("k", "sound", "digits", "marks", "dots", "blanks", "letters", "cue", "prev", "next", "width")


def _let(value: str, name: str, body: str) -> str:
    """`body` with `name` standing for `value`, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _spans(text: str, pattern: str, kind: int, around: bool = False) -> str:
    """Matches of a pattern as structs of kind, start and end in code points, and string; with `around` also of
    `w` and `n`, up to 24 characters before it and one after it, as far as no other match is there.

    A start is the length of all pieces and matches before it, summed up by blocks so that many matches stay
    cheap; what is around comes from the pieces, so it costs the same anywhere in a long text."""
    starts = (
        "aggregate(slice(blocks, 1, cast(i div 256 as int)), 0, (a, b) -> a + b)"
        " + aggregate(slice(steps, cast(i div 256 as int) * 256 + 1, i % 256 + 1), 0, (a, b) -> a + b)"
    )
    more = ", 'w', right(pieces[i], 24), 'n', left(pieces[i + 1], 1)" if around else ""
    kinds = _SPAN.replace("x: string", "x: string, w: string, n: string") if around else _SPAN
    found = _let(starts, "s", f"named_struct('k', {kind}, 's', s, 'e', s + char_length(x), 'x', x{more})")
    blocks = (
        "transform(sequence(0, cast(size(steps) div 256 as int)), n -> aggregate(slice(steps, n * 256 + 1, 256), 0, (a, b) -> a + b))"
    )
    steps = "transform(hits, (x, i) -> char_length(pieces[i]) + if(i = 0, 0, char_length(hits[greatest(i - 1, 0)])))"
    out = _let(blocks, "blocks", f"transform(hits, (x, i) -> {found})")
    out = _let(steps, "steps", out)
    out = _let(f"split({text}, r'{pattern}', -1)", "pieces", out)
    some = _let(f"regexp_extract_all({text}, r'{pattern}', 0)", "hits", f"if(size(hits) = 0, cast(array() as {kinds}), {out})")
    mark = {0: "@", 3: "+"}.get(kind)  # without which the rule cannot match
    has = f"contains({text}, '{mark}')" if mark and pattern in BASE else f"{text} rlike r'[0-9@\\[(]| at '"
    return f"case when {has} then {some} else cast(array() as {kinds}) end"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(x: str) -> str:
    turn = "cast(c as int) * (1 + i % 2)"
    total = f"aggregate(transform(split(reverse({_digits(x)}), ''), (c, i) -> {turn} - if({turn} > 9, 9, 0)), 0, (a, b) -> a + b)"
    return f"{total} % 10 = 0"


def _plausible(kind: int, x: str) -> str:
    """The check of each kind, for the string of a match."""
    digits = f"char_length({_digits(x)})"
    part = "trim(LEADING '0' FROM q)"
    return (
        "true",
        f"forall(split({x}, '[.]'), q -> char_length({part}) <= 3 and coalesce(try_cast({part} as int), 0) <= 255)",
        f"{digits} between 13 and 19 and {_luhn(x)}",
        f"{digits} between 9 and 15",
    )[kind]


def _kind(char: str) -> str:
    return f"case when {char} = '' then 0 when {char} rlike '[ \\t\\r\\n]' then 1 when {char} rlike '[0-9A-Za-z]' then 2 else 3 end"


def _sound(kind: int, x: str) -> str:
    """A stricter check of each kind, for the string of a candidate: what fails it is no personal data."""
    plain = rf"regexp_replace(regexp_replace({x}, r' ?[(\[]at[)\]] ?| ?@ ?', '@'), r' ?[(\[]dot[)\]] ?| dot ', '.')"
    groups = f"size(split({x}, ':+'))"
    date = r"^(?:(?:19|20)[0-9]{2}[ ./-][0-9]{2}[ ./-][0-9]{2}|[0-9]{1,2}[ ./-][0-9]{1,2}[ ./-](?:19|20)[0-9]{2})(?![0-9])"
    return (
        # a mark for at, and a last label of letters
        f"{plain} rlike r'^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)*[.](?:[a-z]{{2,24}}|[A-Z]{{2,24}})$'",
        f"if(contains({x}, ':'), ({groups} = 8 and not contains({x}, '::')) or ({groups} between 3 and 7 and {x} rlike '^[^:]+(?::[^:]+)*::[^:]+(?::[^:]+)*$' and {x} rlike '[A-Fa-f]'),"
        f" size(split({x}, '[.]')) = 4 and {_plausible(1, f"replace({x}, ' ', '')")})",
        _plausible(2, x),
        f"{_plausible(3, x)} and not {x} rlike r'{date}'",
    )[kind]


def _base(text: str) -> str:
    """The base spans of each kind, as an array of arrays."""
    kept = [f"filter({_spans(text, BASE[k], k)}, m -> {_plausible(k, 'm.x')})" for k in range(len(KINDS))]
    return f"array({', '.join(kept)})"


def _met(spans: str, jumps: str, c: str) -> str:
    """Whether `c` overlaps one of `spans`, which follow each other: the last that starts before c's end is
    found by jumps of falling powers of two."""
    before = f"aggregate({jumps}, 0, (n, p) -> if(n + p <= size({spans}), if({spans}[n + p - 1].s < {c}.e, n + p, n), n))"
    return f"(size({spans}) > 0 and {_let(before, 'n', f'n > 0 and {spans}[greatest(n - 1, 0)].e > {c}.s')})"


def _candidates(text: str, base: str) -> str:
    """Candidates of all generators with their features; `label` is 1 where the rule of the kind agrees,
    0 where another rule does or the stricter check fails, and null where only the trees can tell."""
    out = []
    for k in range(len(KINDS)):
        others = " or ".join(_met(f"{base}[{j}]", f"jumps[{j}]", "c") for j in range(len(KINDS)) if j != k)
        fields = {
            "k": str(k),
            "digits": f"least(char_length({_digits('c.x')}), 20)",
            "marks": "least(char_length(regexp_replace(c.x, '[0-9A-Za-z]', '')), 7)",
            "dots": "least(char_length(regexp_replace(c.x, '[^.]', '')), 7)",
            "blanks": "least(char_length(regexp_replace(c.x, '[^ ]', '')), 7)",
            "letters": "cast(c.x rlike '[A-Za-z]' as int)",
            "sound": f"cast({_sound(k, 'c.x')} as int)",
            "cue": f"cast(lower(c.w) rlike '{CUES[k]}' as int)",
            "prev": _kind("right(c.w, 1)"),
            "next": _kind("c.n"),
            "width": "least(cast(char_length(c.x) div 4 as int), 10)",
            "s": "c.s",
            "e": "c.e",
            "x": "c.x",
            "own": _met(f"{base}[{k}]", f"jumps[{k}]", "c"),
            "other": f"({others})",
        }
        struct = "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"
        out.append(f"transform({_spans(text, LOOSE[k], k, around=True)}, c -> {struct})")
    high = "cast(floor(log2(size(b))) as int)"
    jumps = f"transform({base}, b -> if(size(b) = 0, cast(array() as array<int>), transform(sequence(0, {high}), i -> shiftleft(1, {high} - i))))"
    return _let(jumps, "jumps", f"concat({', '.join(out)})")


#: 1 if the rule of its kind agrees with a candidate, 0 if it is something else, null if only the trees can tell.
_LABEL = "case when {0}own then 1 when {0}other or {0}sound = 0 then 0 end"


@dataclass(frozen=True)
class Selector:
    """For each kind trees as SQL over the features of a candidate (written `@name`), and the margin that it
    has to reach. A kind without a threshold adds nothing."""

    trees: dict[int, list[str]] = field(default_factory=dict)
    thresholds: dict[int, float] = field(default_factory=dict)

    def margin(self, of: str = "") -> str:
        sums = [f"when {of}k = {k} then " + " + ".join(tree.replace("@", of) for tree in trees) for k, trees in sorted(self.trees.items()) if trees]
        return f"case {' '.join(sums)} else 0D end" if sums else "0D"

    def selected(self, of: str) -> str:
        passing = [f"({of}k = {k} and m >= {least!r}D)" for k, least in sorted(self.thresholds.items())]
        return f"({_LABEL.format(of)} is null and {_let(self.margin(of), 'm', ' or '.join(passing) or 'false')})"


def _whole(text: str) -> str:
    return f"coalesce(`{text}`, '')"


def find(selector: Selector, text: str = "text") -> Column:
    """A struct of `base` and `spans`: arrays of structs k (index in KINDS), s, e (code points, end
    exclusive) and x (the string), by kind and then start.

    `base` has the rules' spans, per kind the leftmost matches that do not overlap, less those that fail
    the check; `spans` has them all and the selected candidates that overlap none of them. Null and
    empty texts have none. What a row costs grows with its length and the number of its matches, n, as n log n
    and, with a small factor, as n^2 / 256. Repeated rows get equal spans.
    """
    added = f"filter({_candidates('t', 'base')}, c -> {selector.selected('c.')})"
    added = f"transform({added}, c -> named_struct('k', c.k, 's', c.s, 'e', c.e, 'x', c.x))"
    both = f"named_struct('base', flatten(base), 'spans', array_sort(concat(flatten(base), {added})))"
    return F.expr(_let(_whole(text), "t", _let(_base("t"), "base", both)))


def span_list(spans: str) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, m -> concat(array({names})[m.k], ':', m.s, ':', m.e)), ',')")


def _cut(value: str, size: int) -> str:
    return f"transform(sequence(0, cast(char_length({value}) div {size} as int)), i -> substring({value}, i * {size} + 1, {size}))"


def redacted(spans: str, text: str = "text") -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans by that of the
    first of them. A null text stays null.

    Spans are taken by blocks of 256, each of which starts where all spans before it have ended, and the text between
    them is looked up in pieces of it, so that a long list of spans in a long text costs about its length."""
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    between = lambda a, b: (
        f"substring(array_join(slice(chunks, cast({a} div {_CHUNK} as int) + 1, cast({b} div {_CHUNK} as int) - cast({a} div {_CHUNK} as int) + 1), ''),"
        f" {a} % {_CHUNK} + 1, {b} - {a})"
    )
    step = (
        f"if(m.s >= acc.at, named_struct('out', concat(acc.out, array({between('acc.at', 'm.s')},"
        f" array({names})[m.k])), 'at', m.e), named_struct('out', acc.out, 'at', greatest(acc.at, m.e)))"
    )
    begin = "aggregate(slice(ends, 1, b), 0, (x, y) -> greatest(x, y))"
    block = f"aggregate(slice(sorted, b * 256 + 1, 256), named_struct('out', cast(array() as array<string>), 'at', {begin}), (acc, m) -> {step}, acc -> acc.out)"
    tail = _let("aggregate(ends, 0, (x, y) -> greatest(x, y))", "z", between("z", "char_length(t)"))
    whole = f"array_join(concat(flatten(transform(sequence(0, size(ends) - 1), b -> {block})), array({tail})), '')"
    whole = _let("transform(sequence(0, cast(size(sorted) div 256 as int)), b -> aggregate(slice(sorted, b * 256 + 1, 256), 0, (x, m) -> greatest(x, m.e)))", "ends", whole)
    whole = _let(f"array_sort(transform({spans}, m -> named_struct('s', m.s, 'e', m.e, 'k', m.k)))", "sorted", whole)
    # Chunks of equal length: the last piece of a larger one is empty unless that is the last of all.
    chunks = f"filter(flatten(transform({_cut('t', 64 * _CHUNK)}, c -> {_cut('c', _CHUNK)})), c -> c <> '')"
    return F.expr(f"if(size({spans}) = 0, `{text}`, {_let(_whole(text), 't', _let(chunks, 'chunks', whole))})")


def examples(df: DataFrame, key: str, text: str) -> DataFrame:
    """Labelled candidates of all rows, folded to their features: FEATURES, and positive and negative counts to
    learn from (pos, neg) and to calibrate by (held_pos, held_neg). The hash of its key tells a row's half, and that of
    its text where it has no key. Features have few values each, so the result does not grow with the rows."""
    h = F.when(F.col(key).isNull(), F.xxhash64(text)).otherwise(F.xxhash64(key))
    all_ = _let(_whole(text), "t", _let(_base("t"), "base", _candidates("t", "base")))
    rows = df.select(F.pmod(h, F.lit(2)).alias("fold"), F.explode(F.expr(all_)).alias("c"))
    rows = rows.withColumn("label", F.expr(_LABEL.format("c."))).where(F.col("label").isNotNull())
    count = lambda label, fold: F.sum(((F.col("label") == label) & (F.col("fold") == fold)).cast("long"))
    return keep(
        rows.groupBy(*(F.col(f"c.{f}").alias(f) for f in FEATURES)).agg(
            count(1, 0).alias("pos"), count(0, 0).alias("neg"), count(1, 1).alias("held_pos"), count(0, 1).alias("held_neg")
        )
    )


def _best_split(sums: list, smooth: float) -> tuple[float, str, int, float, float] | None:
    """Gain, feature, cut and the leaves on both sides of the best cut, from sums by feature and value."""
    leaf = lambda g, h: -g / (h + smooth)
    best = None
    for name in FEATURES[1:]:
        values = sorted((r["value"], r["g"], r["h"]) for r in sums if r["feature"] == name)
        g_all, h_all = sum(v[1] for v in values), sum(v[2] for v in values)
        g = h = 0.0
        for value, dg, dh in values:
            g, h = g + dg, h + dh
            gain = g * g / (h + smooth) + (g_all - g) ** 2 / (h_all - h + smooth) - g_all**2 / (h_all + smooth)
            # Sums over many rows differ in their last digits from run to run; that must not settle a tie.
            if best is None or gain > best[0] + 1e-12 + 1e-9 * abs(best[0]):
                best = (gain, name, value, leaf(g, h), leaf(g_all - g, h_all - h))
    return best


def fit(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rounds: int = 12,
    rate: float = 0.3,
    smooth: float = 1.0,
    precision: float = 0.95,
) -> Selector:
    """Trees of depth two for each kind, boosted by Newton steps on the log loss of the labelled candidates.

    A round gives each kind a tree, by two small aggregations over the folded examples by kind, feature and value;
    only these sums reach the driver. The threshold of a kind is the least bound above which the held-out
    examples have `precision`, one false alarm more than there was being counted; a kind whose examples are
    too few to show that has no threshold.
    """
    table = examples(df, key, text)
    cells = ", ".join(f"'{f}', {f}" for f in FEATURES[1:])
    trees: dict[int, list[str]] = {k: [] for k in range(len(KINDS))}

    def sums(side: str) -> dict[tuple, list]:
        prob = f"(1 / (1 + exp(-({Selector(trees).margin()}))))"
        graded = table.where("pos + neg > 0").selectExpr(
            "k", f"{side} as side", f"stack({len(FEATURES) - 1}, {cells}) as (feature, value)", f"pos * ({prob} - 1) + neg * {prob} as g",
            f"(pos + neg) * {prob} * (1 - {prob}) as h",
        )
        found: dict[tuple, list] = {}
        for r in graded.groupBy("k", "side", "feature", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            found.setdefault((r["k"], r["side"]), []).append(r)
        return found

    for _ in range(rounds):
        tops = {k: _best_split(rows, smooth) for (k, _), rows in sums("true").items()}
        tops = {k: top for k, top in tops.items() if top and top[0] > 1e-9}
        if not tops:
            break
        below = sums("case " + " ".join(f"when k = {k} then {top[1]} <= {top[2]}" for k, top in sorted(tops.items())) + " end")
        for k, top in tops.items():
            sides = []
            for side, alone in ((True, top[3]), (False, top[4])):
                found = _best_split(below.get((k, side), []), smooth)
                if found is None or found[0] <= 1e-9:
                    sides.append(f"{rate * alone!r}D")
                else:
                    sides.append(f"if(@{found[1]} <= {found[2]}, {rate * found[3]!r}D, {rate * found[4]!r}D)")
            trees[k].append(f"if(@{top[1]} <= {top[2]}, {sides[0]}, {sides[1]})")

    held = table.where("held_pos + held_neg > 0").selectExpr("k", f"{Selector(trees).margin()} as m", "held_pos", "held_neg")
    return Selector({k: t for k, t in trees.items() if t}, _thresholds(held, precision))


def _thresholds(held: DataFrame, precision: float) -> dict[int, float]:
    by_margin = held.groupBy("k", "m").agg(F.sum("held_pos").alias("pos"), F.sum("held_neg").alias("neg"))
    above = "over (partition by k order by m desc)"
    running = by_margin.selectExpr("k", "m", f"sum(pos) {above} as p", f"sum(neg) {above} as n", f"lead(m) {above} as below")
    good = running.where(F.col("p") >= precision * (F.col("p") + F.col("n") + 1))
    # Half way to the next margin that was seen, as no example tells where between them the bound lies.
    least = good.groupBy("k").agg(F.min_by((F.col("m") + F.coalesce("below", "m")) / 2, "m").alias("m"))
    return {r["k"]: r["m"] for r in least.collect()}
