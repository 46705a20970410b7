"""Personal data by candidate generation and gradient-boosted trees, in DataFrame functions only.

Base matches of the four kinds (email, ip, card, phone) are always spans. High-recall generators propose further,
overlapping candidates: of every run of digits and separators each part of 7 to 23 digits between separators as an address,
a card and a telephone number, and every spelt-out mail address. Boosted trees score a candidate from its format, its
neighbours in the run and the words in front of it, and the candidates above their kind's threshold that touch no base
span, best first where they overlap, become spans too. The trees are trained here on generated examples, and each
threshold is calibrated on templates that the scoring trees have not seen.

A document is one row from end to end: all its matches live in arrays, so nothing is shuffled and one document's
work does not depend on another's. Patterns are possessive or bounded, and arrays are scanned in blocks, so that long
texts and long runs cost linear time.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: Java patterns of the base matches, equal to the greedy ones but without back-tracking through long runs.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Proposals: runs of digits and separators, and mail addresses with a spelt-out @ or dot.
RUN = r"(?<![0-9A-Za-z])[(]?[0-9]++(?![A-Za-z])(?:[\x20().,:/_-]{1,3}[0-9]++(?![A-Za-z]))*+"
LEAST_DIGITS, MOST_DIGITS = 7, 23
SPELT = (
    r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}\x20?(?:[\[({<]\x20?at\x20?[\])}>]|@)\x20?"
    r"[a-z0-9-]{1,63}(?:\x20?(?:[\[({<]\x20?dot\x20?[\])}>]|\.)\x20?[a-z0-9-]{2,63}){1,4}"
)
#: Words in front of a candidate, within ``REACH`` characters, that speak for a kind.
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write)\b",
    "ip": r"(?i)\b(?:ip|ipv4|host|server|address)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|fax|mobile|cell)\b",
}
REACH = 24
#: Training: examples a template, rounds, learning rate, folds of templates, and the precision that a threshold must
#: reach on templates that were held out.
EXAMPLES, ROUNDS, RATE, FOLDS, PRECISION = 16, 30, 0.4, 4, 0.98
FEATURES = ("digits", "groups", "longest", "shortest", "dots", "dashes", "spaces", "others", "brackets", "zeros", "luhn", "octets", "at", "dot", "tied", "spaced", "loose", "named", "c_email", "c_ip", "c_card", "c_phone")
#: Fixed templates: kind, whether it is personal data, and the text, in which 9 stands for any digit, 5 for one of
#: 1 to 9, and L for digits that make the whole pass the Luhn check; of addresses, {w} stands for a name, {h} for a host
#: and {t} for its end, each with digits or without. In lists, ~ parts what stands between numbers from them, and a
#: number in << >> is none.
TEMPLATES = (
    ("phone", 1, "(599) 999-9999"), ("phone", 1, "599-999-9999"), ("phone", 1, "phone 599.999.9999"), ("phone", 1, "tel: 599 999 9999"),
    ("phone", 1, "call 5999999999"), ("phone", 1, "0059 59 9999 9999"), ("phone", 1, "fax 099 9999999"), ("phone", 1, "mobile 09999 999999"),
    ("phone", 1, "(599) 999-9999~, ~(599) 999-9999"), ("phone", 1, "599-999-9999~ / ~599-999-9999"), ("phone", 1, "<<2099-09-09>>~ ~(599) 999-9999"),
    ("phone", 1, "(599) 999-9999~, ~(599) 999-9999~, ~(599) 999-9999~, ~(599) 999-9999"), ("phone", 1, "599-999-9999~ ~599-999-9999~ ~599-999-9999"),
    ("phone", 1, "599-999-9999~, ~599-999-9999~, ~599-999-9999"), ("phone", 1, "(599) 999-9999~ / ~599-999-9999"), ("phone", 1, "<<2099-09-09 09:09>>~ ~599-999-9999"),
    ("phone", 1, "<<59>>~, ~(599) 999-9999"), ("phone", 1, "(599) 999-9999~, ~<<59>>~, ~<<59.99>>"), ("phone", 1, "<<599>>~ ~599-999-9999~ ~<<59>>"),
    ("phone", 0, "2099-09-09 09:09"), ("phone", 0, "2099-09-09, 2099-09-09, 2099-09-09"), ("phone", 0, "599 999 9999 599 99 9999"), ("phone", 0, "59.9, 99.9, 599.99, 9.99"), ("phone", 0, "09.09.2099 09:09"), ("phone", 0, "59,999,999"), ("phone", 0, "59999999"),
    ("phone", 0, "5999999999"), ("phone", 0, "order 599999-9999"), ("phone", 0, "599, 599, 599"), ("phone", 0, "5.99.99.99.9"), ("phone", 0, "59:99:99.999"),
    ("phone", 0, "59/59/59/59"), ("phone", 0, "978-5-999-99999-9"), ("phone", 0, "599-599-599-599"), ("phone", 0, "5999 5999 5999 5999"),
    ("card", 1, "LLLL.LLLL.LLLL.LLLL"), ("card", 1, "LLLL_LLLL_LLLL_LLLL"), ("card", 1, "card LLLL/LLLL/LLLL/LLLL"), ("card", 1, "visa LLLLLLLLLLLLL"),
    ("card", 1, "LLLL  LLLL  LLLL  LLLL"), ("card", 1, "credit card: LLLL - LLLL - LLLL - LLLL"), ("card", 1, "amex LLLL.LLLLLL.LLLLL"),
    ("card", 1, "LLLL.LLLL.LLLL.LLLL~, ~LLLL.LLLL.LLLL.LLLL"), ("card", 1, "LLLL_LLLL_LLLL_LLLL~ / ~LLLL_LLLL_LLLL_LLLL"),
    ("card", 0, "(599) 999-9999, (599) 999-9999"), ("card", 0, "599-999-9999, 599-999-9999"), ("card", 0, "5999.9999.9999.9999"), ("card", 0, "5999999999999"), ("card", 0, "LLLLLLLLLLLLL"), ("card", 0, "2099-09-09 09:09:09"), ("card", 0, "599,599,599,599"),
    ("card", 0, "09.09.2099 - 09.09.2099"), ("card", 0, "978-5-999-99999-9"), ("card", 0, "5 9 9 9 9 9 9"), ("card", 0, "5:99:99:99:99"), ("card", 0, "card 59999999"),
    ("ip", 1, "ip 599-99-99-99"), ("ip", 1, "host 59,59,59,59"), ("ip", 1, "server 199 99 99 99"), ("ip", 1, "ip address: 59_59_59_59"),
    ("ip", 0, "(599) 999-9999, (599) 999-9999"), ("ip", 0, "59-59-59-59"), ("ip", 0, "59/59/59/59"), ("ip", 0, "599 99 99 99"), ("ip", 0, "2099-09-09 09:09"), ("ip", 0, "ip 5999999999"),
    ("ip", 0, "server 5999-9999"), ("ip", 0, "(599) 999-9999"), ("ip", 0, "59,999,999"), ("ip", 0, "5.9.9.9.9.9.9"), ("ip", 0, "599-999-9999"),
    ("email", 1, "{w} [at] {h} [dot] {t}"), ("email", 1, "{w}.{w} (at) {h} (dot) {t}"), ("email", 1, "{w}(at){h}.{t}"), ("email", 1, "{w}[at]{h}[dot]{t}"),
    ("email", 1, "email {w}.{w} [at] {h}.{t}"), ("email", 1, "{w} <at> {h} <dot> {t}"), ("email", 1, "write {w} (at) {h} [dot] {t}"), ("email", 1, "mail me: {w}_{w} [at] {h} [dot] co [dot] {t}"),
    ("email", 1, "contact {w} @ {h}.{t}"), ("email", 1, "mail: {w}@ {h}.co.{t}"), ("email", 1, "{w}.{w} @ {h}.{t}"), ("email", 1, "e-mail {w} @{h}.{t}"), ("email", 1, "{w} {at} {h} {dot} {t}"),
    ("email", 0, "{w} @ {h}. {w}"), ("email", 0, "cost 5 @ 99.99"), ("email", 0, "see {w} @ {h}. {w}"), ("email", 0, "9 @ 9.99"), ("email", 0, "{w} @ {h}. {w}. {w}"),
    ("email", 0, "599 @ 59.99"), ("email", 0, "mail {w} @ {h}. {w}"), ("email", 0, "{w} @{h}. {w}"), ("email", 0, "contact {w} @ 59.99"), ("email", 0, "59.9 @ 5.999"),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, join: Callable[[Column, Column], Column] = lambda a, b: a + b, start: Column | None = None) -> Column:
    """What ``join`` makes of all that stand before each element of an array of longs, by default their sum, in blocks so
    that long arrays stay cheap."""
    none = F.array().cast("array<bigint>")
    start = F.lit(0).cast("long") if start is None else start

    def within(xs: Column) -> Column:
        first = F.struct(none.alias("out"), start.alias("last"))
        step = lambda a, x: F.struct(F.concat(a["out"], F.array(a["last"])).alias("out"), join(a["last"], x).alias("last"))
        return F.aggregate(xs, first, step, lambda a: a["out"])

    def whole(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / 256).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.slice(values, i * 256 + 1, 256))
        return _let(blocks, lambda own: F.flatten(F.zip_with(own, within(F.transform(own, lambda b: F.aggregate(b, start, lambda x, y: join(x, y)))), lambda b, o: F.transform(within(b), lambda x: join(x, o)))))

    return _let(values, whole)


def _cut_out(coded: Column, start: Column, n: Column) -> Column:
    """``n`` code points from ``start`` (from 0) of a text in UTF-32, where each place is found at once."""
    return F.decode(F.substring(coded, (start * 4 + 1).cast("int"), (n * 4).cast("int")), "UTF-32")


def _found(text: Column, pattern: str, guard: Column) -> Column:
    """All matches as structs (start, stop, text, before); positions count code points, ``before`` is context."""
    got = F.when(guard, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.when(guard, F.split(text, pattern, -1))
    pair = F.zip_with(gaps, got, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    pair = F.filter(pair, lambda p: p["m"].isNotNull())
    moved = _running(F.transform(pair, lambda p: (F.length(p["g"]) + F.length(p["m"])).cast("long")))
    spans = F.zip_with(
        pair, moved,
        lambda p, at: F.struct(
            (at + F.length(p["g"])).alias("start"),
            (at + F.length(p["g"]) + F.length(p["m"])).alias("stop"),
            p["m"].alias("text"),
            F.substring(p["g"], -REACH, REACH).alias("before"),
        ),
    )
    return F.coalesce(spans, F.array().cast("array<struct<start:bigint,stop:bigint,text:string,before:string>>"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column, width: int = 24) -> Column:
    """Whether up to ``width`` digits pass the Luhn check."""

    def total(padded: Column) -> Column:
        out = F.lit(0)
        for i in range(width):
            d = F.substring(padded, width - i, 1).cast("int")
            out = out + (d if i % 2 == 0 else F.when(d > 4, d * 2 - 9).otherwise(d * 2))
        return out

    return (F.length(digits) > 0) & (F.length(digits) <= width) & (_let(F.lpad(digits, width, "0"), total) % 10 == 0)


def _valid(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(text, r"\.", -1), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    n = F.length(_digits(text))
    if kind == "card":
        return n.between(14, 19) & _luhn(_digits(text))
    return n.between(10, 15)


_GUARD = {"email": lambda t: t.contains("@"), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike("[0-9]{2}|[0-9][ -][0-9]"), "phone": lambda t: t.rlike(r"\+[0-9]")}


def _base(text: Column) -> Column:
    """Base matches that pass their check, as structs (start, rank of the kind, stop), kind by kind."""

    def of(rank: int, kind: str) -> Column:
        good = F.filter(_found(text, BASE[kind], _GUARD[kind](text)), lambda s: _valid(kind, s["text"]))
        return F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("kind"), s["stop"].alias("stop")))

    return F.array_sort(F.concat(*(of(rank, kind) for rank, kind in enumerate(KINDS))))


def _features(s: Column) -> list[Column]:
    """The features of one proposal, in the order of ``FEATURES``."""
    t, before = s["text"], s["before"]
    groups = F.filter(F.split(t, "[^0-9]+"), lambda g: g != "")
    sizes = F.transform(groups, lambda g: F.length(g))
    count = lambda p: F.regexp_count(t, F.lit(p))
    flag = lambda c: c.cast("int")
    octets = (F.size(groups) == 4) & F.forall(groups, lambda g: (F.length(g) <= 3) & (F.lpad(g, 3, "0") <= "255"))
    return [
        F.length(_digits(t)), F.size(groups), F.coalesce(F.array_max(sizes), F.lit(0)), F.coalesce(F.array_min(sizes), F.lit(0)),
        count(r"\."), count("-"), count(" "), count("[,:/_]"), count("[()]"), flag(t.startswith("00")), flag(_luhn(_digits(t))), flag(octets),
        flag(t.rlike(r"(?i)[\[({<]\x20?at\x20?[\])}>]")), flag(t.rlike(r"(?i)[\[({<]\x20?dot\x20?[\])}>]")),
        flag(s["left"].rlike(r"^[.,:/_-][(]?$")) + flag(s["right"].rlike("^[.,:/_-]$")), flag(s["left"].rlike(r"^[)]?\x20[(]?$")) + flag(s["right"].rlike(r"^[)]?\x20$")),
        count(r"\.\x20"), flag(t.rlike("[A-Za-z]{2}$")), *(flag(before.rlike(CONTEXT[k])) for k in KINDS),
    ]


def _parts(run: Column, made: Callable[[Column], Column]) -> Column:
    """What ``made`` makes of the structs (start, stop, text, before, left, right) of the parts of a run that begin and end
    at a separator and have ``LEAST_DIGITS`` to ``MOST_DIGITS`` digits, of those with one beginning at a time; left and right
    are the separators beside a part within the run."""
    digits = F.regexp_extract_all(run["text"], F.lit("[0-9]+"), F.lit(0))
    lines = F.struct(digits.alias("digits"), F.split(run["text"], "[0-9]+", -1).alias("seps"), F.encode(F.concat(run["before"], run["text"]), "UTF-32").alias("all"), F.length(run["before"]).alias("skip"), run["start"].alias("start"))

    def measured(r: Column) -> Column:
        whole = F.zip_with(F.slice(r["seps"], 1, F.size(r["digits"])), r["digits"], lambda s, d: (F.length(s) + F.length(d)).cast("long"))
        own = F.transform(r["digits"], lambda d: F.length(d).cast("long"))
        return F.struct(*(r[c].alias(c) for c in ("digits", "seps", "all", "skip", "start")), _running(whole).alias("ends"), _running(own).alias("before"))

    def window(r: Column, i: Column) -> Column:
        """What a part from group i can reach, so that parts of long runs are taken from short texts."""
        left = F.get(r["seps"], i)
        start = F.get(r["ends"], i) + F.length(left) - left.endswith("(").cast("int")
        reach = F.least(F.lit(REACH), r["skip"] + start)
        near = _cut_out(r["all"], r["skip"] + start - reach, reach + 4 * MOST_DIGITS + 1)
        return F.struct(start.alias("start"), reach.cast("int").alias("reach"), near.alias("near"), F.when(i > 0, left).otherwise("").alias("left"))

    def part(r: Column, w: Column, j: Column) -> Column:
        stop = F.get(r["ends"], j) + F.length(F.get(r["seps"], j)) + F.length(F.get(r["digits"], j))
        return F.struct(
            (r["start"] + w["start"]).alias("start"), (r["start"] + stop).alias("stop"),
            F.substring(w["near"], w["reach"] + 1, (stop - w["start"]).cast("int")).alias("text"),
            F.substring(w["near"], F.lit(1), w["reach"]).alias("before"), w["left"].alias("left"), F.get(r["seps"], j + 1).alias("right"),
        )

    def at(r: Column, i: Column) -> Column:
        last = F.least(F.size(r["digits"]) - 1, i + MOST_DIGITS - 1)
        many = lambda j: F.get(r["before"], j) + F.length(F.get(r["digits"], j)) - F.get(r["before"], i)
        fit = F.filter(F.sequence(i, last), lambda j: many(j).between(LEAST_DIGITS, MOST_DIGITS))
        return made(F.when(F.size(fit) > 0, _let(window(r, i), lambda w: F.transform(fit, lambda j: part(r, w, j)))).otherwise(none))

    none = F.array().cast("array<struct<start:bigint,stop:bigint,text:string,before:string,left:string,right:string>>")
    return _let(lines, lambda r: _let(measured(r), lambda m: F.flatten(F.transform(F.sequence(F.lit(0), F.size(m["digits"]) - 1), lambda i: at(m, i)))))


def _proposals(text: Column, made: Callable[[Column, bool], Column]) -> Column:
    """What ``made`` makes of the overlapping proposals of a text, structs (start, stop, text, before, left, right), and of
    whether they are spelt-out addresses, all in one array."""
    runs = _found(text, RUN, text.rlike("[0-9][^A-Za-z]{0,12}[0-9]"))
    runs = F.filter(runs, lambda r: F.length(_digits(r["text"])) >= LEAST_DIGITS)
    spelt = _found(text, SPELT, text.contains("@") | text.rlike(r"(?i)[\[({<]\x20?at\x20?[\])}>]"))
    alone = lambda s: F.struct(*(s[c].alias(c) for c in ("start", "stop", "text", "before")), F.lit("").alias("left"), F.lit("").alias("right"))
    return F.concat(F.flatten(F.transform(runs, lambda r: _parts(r, lambda found: made(found, False)))), made(F.transform(spelt, alone), True))


def _with_features(found: Column, is_spelt: bool) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.lit(is_spelt).alias("spelt"), F.array(*_features(s)).alias("f")))


Tree = tuple  # (feature, limit, left, right), or a leaf's value


def _fit_tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int) -> Tree | float:
    leaf = float(grad.sum() / (hess.sum() + 1.0))
    if depth == 0:
        return leaf
    best, split = grad.sum() ** 2 / (hess.sum() + 1.0) + 1e-6, None
    for j in range(x.shape[1]):
        limits, code = np.unique(x[:, j], return_inverse=True)
        g, h = (np.cumsum(np.bincount(code, weights=w)) for w in (grad, hess))
        gains = g[:-1] ** 2 / (h[:-1] + 1.0) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1.0)
        if len(gains) and gains.max() > best:
            best, split = float(gains.max()), (j, int(limits[gains.argmax()]))
    if split is None:
        return leaf
    left = x[:, split[0]] <= split[1]
    return (*split, _fit_tree(x[left], grad[left], hess[left], depth - 1), _fit_tree(x[~left], grad[~left], hess[~left], depth - 1))


def _apply(tree: Tree | float, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] <= tree[1], _apply(tree[2], x), _apply(tree[3], x))


def _column(tree: Tree | float, f: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    return F.when(f[tree[0]] <= tree[1], _column(tree[2], f)).otherwise(_column(tree[3], f))


def boost(x: np.ndarray, y: np.ndarray) -> list[Tree | float]:
    """Trees of depth 3 whose summed leaves, times ``RATE``, are the log-odds of ``y`` (logistic loss, Newton steps)."""
    trees, score = [], np.zeros(len(y))
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        tree = _fit_tree(x, y - p, p * (1 - p), 3)
        trees.append(tree)
        score += RATE * _apply(tree, x)
    return trees


_LETTERS, _ENDS = "abcdefghijklmnopqrstuvwxyz", ("com", "org", "net", "de", "io", "info", "uk", "edu")


def _word(r: random.Random) -> str:
    return "".join(r.choice(_LETTERS) for _ in range(r.randint(3, 9))) + (str(r.randrange(100)) if r.random() < 0.3 else "")


def _filled(r: random.Random, kind: str, label: int, shape: str) -> str:
    if kind == "email":
        shape = re.sub(r"\{w\}|\{h\}", lambda _: _word(r), shape).replace("{t}", r.choice(_ENDS))
    if not ("9" in shape or "5" in shape or "L" in shape):
        return shape
    text = "".join(str(r.randrange(10)) if c in "9L" else str(r.randint(1, 9)) if c == "5" else c for c in shape)
    if kind == "ip" and label:
        text = "".join(str(r.randrange(10)) if c == "9" else str(r.randint(1, 2)) if c == "5" else c for c in shape.replace("599", "199"))
    if "L" in shape:
        digits = [int(c) for c in text if c.isdigit()]
        odd = sum(d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for k, d in enumerate(reversed(digits)))
        text = text[:-1] + str((int(text[-1]) - odd) % 10)
    elif kind == "card" and not label and sum(c.isdigit() for c in text) > 13:  # not one by chance
        digits = [int(c) for c in text if c.isdigit()]
        odd = sum(d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for k, d in enumerate(reversed(digits)))
        text = text if odd % 10 else text[:-1] + str((int(text[-1]) + 1) % 10)
    return text


def examples(seed: int = 7, templates: tuple = TEMPLATES) -> list[tuple[str, list[tuple[int, int]], str]]:
    """Generated (kind, spans, text) rows, ``EXAMPLES`` for each template in a row; nothing comes from the corpus."""
    r, out = random.Random(seed), []
    for kind, label, shape in templates:
        for _ in range(EXAMPLES):
            text, spans = "", []
            for piece in shape.split("~"):
                own = _filled(r, kind, label, piece.removeprefix("<<").removesuffix(">>"))
                number = re.search("[(]?[0-9].*[0-9]", own)
                if kind == "email":
                    if label:
                        spans.append((0, len(own)))
                elif label and number and not piece.startswith("<<"):
                    spans.append((len(text) + number.start(), len(text) + number.end()))
                text += own
            out.append((kind, spans, text))
    return out


def _measured(spark: SparkSession, given: list[tuple[str, list[tuple[int, int]], str]]) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features, labels, template numbers) of each kind's proposals in given examples, by the expressions that documents use."""
    lines = "\n".join(f"{k}|{t}" for k, _, t in given)
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(lines), "\n")).alias("n", "line"))
    rows = rows.select("n", F.split("line", r"\|").alias("p")).select("n", F.col("p")[0].alias("kind"), F.col("p")[1].alias("t"))
    got = rows.select("n", "kind", F.inline(_proposals(F.col("t"), _with_features))).where((F.col("kind") == "email") == F.col("spelt")).collect()
    out = {}
    for kind in KINDS:
        own = [g for g in sorted(got, key=lambda g: (g["n"], g["start"], g["stop"])) if g["kind"] == kind]
        y = [int(bool(given[g["n"]][1]) if g["spelt"] else (g["start"], g["stop"]) in given[g["n"]][1]) for g in own]
        out[kind] = np.array([g["f"] for g in own]), np.array(y), np.array([g["n"] // EXAMPLES for g in own])
    return out


def _limit(score: np.ndarray, y: np.ndarray) -> float:
    """The lowest score from which on precision stays at ``PRECISION`` or more, and not below even odds."""
    limit = 1e9
    for s in sorted(set(score.tolist()), reverse=True):
        if s < 0 or y[score >= s].mean() < PRECISION:
            break
        limit = s
    return limit - 1e-9


_TRAINED: dict[str, tuple[list, float]] = {}


def train(spark: SparkSession) -> dict[str, tuple[list, float]]:
    """Trees and threshold of each kind, trained once in a process, as nothing but the templates goes into them.

    The templates are dealt into ``FOLDS``. Trees of all folds but one score that one, so every score that calibrates the
    threshold is of a template that its trees have not seen. The trees in use are trained on all templates.
    """
    if _TRAINED:
        return _TRAINED
    model = {}
    for kind, (x, y, template) in _measured(spark, examples()).items():
        fold = np.unique(template, return_inverse=True)[1] % FOLDS
        score = np.zeros(len(y))
        for f in range(FOLDS):
            score[fold == f] = RATE * sum(_apply(t, x[fold == f]) for t in boost(x[fold != f], y[fold != f]))
        model[kind] = boost(x, y), _limit(score, y)
    _TRAINED.update(model)
    return _TRAINED


def judged(spark: SparkSession, templates: tuple, model: dict[str, tuple[list, float]]) -> dict[str, tuple[float, float]]:
    """(precision, recall) of each kind's trees and threshold on the proposals of other templates."""
    out = {}
    for kind, (x, y, _) in _measured(spark, examples(23, templates)).items():
        trees, limit = model[kind]
        taken = RATE * sum(_apply(t, x) for t in trees) >= limit
        out[kind] = float(y[taken].mean()) if taken.any() else 1.0, float(taken[y == 1].mean())
    return out


def _taken(text: Column, model: dict[str, tuple[list, float]]) -> Column:
    """Proposals above their kind's threshold as structs (start, stop, kind, score), with the best kind of each."""

    def judge(p: Column) -> Column:
        best = []
        for rank, kind in enumerate(KINDS):
            trees, limit = model[kind]
            score = reduce(lambda a, b: a + b, (_column(t, p["f"]) for t in trees)) * RATE
            best.append(F.struct(_let(score, lambda x: F.when((p["spelt"] == F.lit(kind == "email")) & (x >= limit), x)).alias("score"), F.lit(rank).alias("kind")))
        top = F.array_max(F.array(*best))
        return _let(top, lambda x: F.struct(p["start"].alias("start"), p["stop"].alias("stop"), x["kind"].alias("kind"), x["score"].alias("score")))

    return _proposals(text, lambda found, is_spelt: F.filter(F.transform(_with_features(found, is_spelt), judge), lambda s: s["score"].isNotNull()))


def _apart(both: Column) -> Column:
    """The proposals among sorted spans, base ones without a score, that no base span reaches into."""
    far = F.lit(1 << 60)
    stops = F.transform(both, lambda s: F.when(s["score"].isNull(), s["stop"]).otherwise(F.lit(0).cast("long")))
    starts = F.reverse(F.transform(both, lambda s: F.when(s["score"].isNull(), s["start"]).otherwise(far)))
    ends, next_ = _running(stops, lambda x, y: F.greatest(x, y)), F.reverse(_running(starts, lambda x, y: F.least(x, y), far))
    free = F.zip_with(F.arrays_zip(both.alias("s"), ends.alias("e")), next_, lambda x, n: F.when((x["e"] <= x["s"]["start"]) & (n >= x["s"]["stop"]) & x["s"]["score"].isNotNull(), x["s"]))
    return F.filter(free, lambda s: s.isNotNull())


def _chosen(group: Column) -> Column:
    """Of a group of overlapping spans, those of the highest scores that don't overlap."""
    best = F.array_sort(F.transform(group, lambda s: F.struct((-s["score"]).alias("rank"), s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))))
    none = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>")
    own = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))
    meets = lambda a, s: F.exists(a, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    return F.aggregate(best, none, lambda a, s: F.when(meets(a, s), a).otherwise(F.concat(a, F.array(own(s)))))


def _added(df: DataFrame, text: Column, base_as: str, into: str, model: dict[str, tuple[list, float]]) -> DataFrame:
    """``df`` with the sorted structs (start, kind, stop) of the proposals that are taken and touch no base span; of
    overlapping ones those of higher scores. Steps are columns, as Spark resolves nested functions level by level."""
    steps, names = ["taken", "free", "groups"], []
    for step in steps:
        names.append(_unused(df, step))
        df = df.withColumn(names[-1], F.lit(None))
    taken, free, groups = names
    df = df.withColumn(taken, _taken(text, model))
    marks = F.transform(base_as, lambda b: F.struct(b["start"].alias("start"), b["stop"].alias("stop"), b["kind"].alias("kind"), F.lit(None).cast("double").alias("score")))
    df = df.withColumn(free, F.when(F.size(taken) > 0, F.array_sort(F.concat(marks, F.col(taken)), lambda a, b: _order(a, b))).otherwise(F.slice(taken, 1, 0)))
    df = df.withColumn(free, F.when(F.size(taken) > 0, _apart(F.col(free))).otherwise(F.col(free)))
    df = df.withColumn(groups, _groups(F.col(free)))
    each = F.transform(groups, lambda g: _chosen(F.slice(free, g["first"] + 1, g["n"])))
    return df.withColumn(into, F.flatten(each)).drop(*names)


def _order(a: Column, b: Column) -> Column:
    """By start, spans without a score first."""
    base = lambda s: s["score"].isNotNull().cast("int")
    return F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(base(a) - base(b))).cast("int")


def _groups(found: Column) -> Column:
    """(first, n, stop) of the groups of overlapping spans in a sorted array, first counted from 0."""
    before = _running(F.transform(found, lambda s: s["stop"]), lambda x, y: F.greatest(x, y))
    marked = F.zip_with(found, before, lambda s, e: F.struct((s["start"] >= e).alias("new"), F.greatest(e, s["stop"]).alias("stop")))

    def of(rows: Column) -> Column:
        last = F.size(rows) - 1
        firsts = F.filter(F.sequence(F.lit(0), last), lambda i: F.get(rows, i)["new"])
        lasts = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | F.get(rows, i + 1)["new"])
        return F.zip_with(firsts, lasts, lambda i, j: F.struct(i.alias("first"), (j - i + 1).alias("n"), F.get(rows, j)["stop"].alias("stop")))

    none = F.array().cast("array<struct<first:int,n:int,stop:bigint>>")
    return F.when(F.size(found) > 0, _let(marked, of)).otherwise(none)


def spans(docs: DataFrame, text_col: str = "text", base_as: str = "base", all_as: str = "spans") -> DataFrame:
    """``docs`` with two arrays of structs (start, kind, stop), sorted: its base spans, and all its spans.

    kind is an index into ``KINDS``; positions count code points and ``stop`` is exclusive. A null text counts as
    empty and has no spans. Rows are independent: repeated rows give repeated results, no rows give none. The two
    columns replace any of the same names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    model = train(docs.sparkSession)
    found = _added(docs.withColumn(base_as, _base(text)), text, base_as, all_as, model)
    return found.withColumn(all_as, F.array_sort(F.array_distinct(F.concat(F.col(base_as), F.col(all_as)))))


def listed(spans_col: Column) -> Column:
    """kind:start:stop of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans_col, one), ",")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets; overlapping spans become one.

    A null text stays null. All other columns stay as they are, whatever their names.
    """
    base_as, all_as, groups_as = (_unused(docs, c) for c in ("base", "spans", "groups"))
    found, text = spans(docs, text_col, base_as, all_as), F.col(text_col)
    long0 = F.lit(0).cast("long")
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    groups = F.transform(_groups(F.col(all_as)), lambda g: F.struct(F.get(all_as, g["first"])["start"].alias("start"), g["stop"].alias("stop"), F.get(all_as, g["first"])["kind"].alias("kind")))

    def rebuilt(g: Column) -> Column:
        ends = F.concat(F.array(long0), F.transform(g["spans"], lambda s: s["stop"]))
        starts = F.concat(F.transform(g["spans"], lambda s: s["start"]), F.array(F.length(text).cast("long")))
        between = F.zip_with(ends, starts, lambda e, s: _cut_out(g["coded"], e, s - e))
        marks = F.concat(F.transform(g["spans"], lambda s: F.get(names, s["kind"])), F.array(F.lit("")))
        return F.array_join(F.zip_with(between, marks, lambda b, m: F.concat(b, m)), "")

    found = found.withColumn(groups_as, groups)
    clean = _let(F.struct(F.col(groups_as).alias("spans"), F.encode(text, "UTF-32").alias("coded")), rebuilt)
    changed = F.when(F.size(all_as) > 0, clean).otherwise(text)
    return found.withColumn(text_col, changed).drop(base_as, all_as, groups_as)


def _unused(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
