"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base spans come from four patterns with their checks and always stay.  High
recall generators propose further, overlapping spans (spaced or spelled-out
addresses, numbers without a plus sign, loose digit runs, bracketed IPs,
account numbers).  A candidate is described by small binned features of its
format and of the text around it; boosted depth-two trees score it, and per
generator a threshold calibrated on the other half of the documents selects
the spans that are added.

The trees need labels, and the tables have none for personal data, so each
generator has a check of its own kind (``_verified``): an address that is whole
once ``(at)`` and ``(dot)`` are written out, four parts up to 255, Luhn's
digits, the phone rule once a leading 00 is a plus sign, an IBAN's remainder
of 97; a local number is verified where it is part of an international one.
The features describe format and context and restate none of these checks.  The
model learns where verified data stands and accepts formats that hold mostly
verified data.  All candidates of all texts are counted into cells of equal
features (one pre-aggregated shuffle); boosting runs on the ``MAX_CELLS``
largest, and the rows of the others count against every threshold, so its size
does not depend on the corpus.  Spans and candidates are matched once and
written; the fitted trees become one SQL expression over them.  Texts are never
shuffled.

Positions are code points, end exclusive.  They are found without leaving the
row: the gaps between matches and the matches themselves are summed up, in
chunks, so that a text with very many matches stays linear.  All patterns
start behind a boundary or use possessive repeats, so that long runs of one
kind of character do not cost a time in their square.

Edge cases: a null text is empty; empty texts have no span; without a single
base span no candidate is accepted; each row is handled by itself, so repeated
rows and any ids are fine; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import stored

KINDS = ("email", "ip", "card", "phone", "account")
MAX_CELLS = 20_000
ROUNDS, RATE, LEAST_CHILD = 30, 0.3, 5.0
PRECISION, LEAST_SUPPORT = 0.9, 20
CHUNK = 256

_LOCAL = "A-Za-z0-9._%+-"
# The base patterns of the contract.  A match may start where the
# last one ended (\G) or behind a character that could not belong to it.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Generators: kind of the span that they propose, and pattern.
GENERATORS = (
    ("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
              r"(?:(?:\x20?\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\.|\[\.\]|\(\.\))\x20?[0-9]{1,3}){3}(?![0-9.])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20.-]{1,2}[0-9]{4}){2,3}(?:[\x20.-]{1,2}[0-9]{1,3})?(?![0-9])"),
    ("phone", r"(?<![0-9+])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,5}(?![0-9])"),
    ("phone", r"(?<![0-9])00[0-9]{1,3}[\x20().0-9-]{7,16}[0-9](?![0-9])"),
    ("account", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
)
# Words that announce a kind of data.
CONTEXT = (r"(?i)\b(?:e-?mail|mail|contact|write)\b", r"(?i)\b(?:ip|host|server|address|ping)\b",
           r"(?i)\b(?:card|visa|credit|payment|carte|tarjeta|karte)\b",
           r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|llame)\b", r"(?i)\b(?:iban|account|konto|compte|cuenta)\b")
FEATURES = ("gen", "digits", "marks", "variety", "before", "after", "context", "dots", "size")


def _step(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns behind a generator, so that the optimizer does not copy
    them into the functions that use them per array element."""
    one = F.explode(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))).alias("__step")
    return df.select("*", one).select(*df.columns, *[F.col(f"__step.{n}").alias(n) for n in cols])


def _walk(pieces: Column, start: Column) -> Column:
    """Spans of (gap, match) pieces that begin at ``start``."""
    typed = "array<struct<s:int,e:int,m:string>>"
    return F.aggregate(
        pieces, F.struct(start.alias("p"), F.array().cast(typed).alias("out")),
        lambda a, x: F.struct(
            (a["p"] + x["g"] + F.char_length(x["m"])).alias("p"),
            F.concat(a["out"], F.array(F.struct((a["p"] + x["g"]).alias("s"),
                                                (a["p"] + x["g"] + F.char_length(x["m"])).alias("e"),
                                                x["m"].alias("m")))).alias("out")),
        lambda a: a["out"])


def find(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Per pattern a column of its leftmost non-overlapping matches in
    ``text``: array of (s, e, m), positions in code points."""
    names = list(patterns)
    df = _step(df, **{f"__m_{n}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for n, p in patterns.items()})
    df = _step(df, **{f"__g_{n}": F.when(F.size(f"__m_{n}") > 0, F.split(text, p, -1)) for n, p in patterns.items()})
    df = _step(df, **{f"__p_{n}": _pieces(n) for n in names})
    df = _step(df, **{f"__c_{n}": _chunks(n) for n in names})
    df = _step(df, **{f"__o_{n}": _starts(n) for n in names})
    df = _step(df, **{n: _positions(n) for n in names})
    return df.drop(*[f"__{k}_{n}" for k in "mgpco" for n in names])


def _pieces(n: str) -> Column:
    return F.transform(f"__m_{n}", lambda m, i: F.struct(
        F.char_length(F.get(f"__g_{n}", i)).alias("g"), m.alias("m")))


def _chunks(n: str) -> Column:
    return F.when(F.size(f"__p_{n}") > 0, F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(f"__p_{n}") / CHUNK).cast("int") - 1),
        lambda c: F.slice(f"__p_{n}", c * CHUNK + 1, F.lit(CHUNK))))


def _starts(n: str) -> Column:
    size = lambda c: F.aggregate(c, F.lit(0), lambda k, x: k + x["g"] + F.char_length(x["m"]))
    return F.aggregate(
        f"__c_{n}", F.struct(F.lit(0).alias("p"), F.array().cast("array<int>").alias("out")),
        lambda a, c: F.struct((a["p"] + size(c)).alias("p"), F.concat(a["out"], F.array(a["p"])).alias("out")),
        lambda a: a["out"])


def _positions(n: str) -> Column:
    empty = F.array().cast("array<struct<s:int,e:int,m:string>>")
    return F.coalesce(F.flatten(F.transform(f"__c_{n}", lambda c, i: _walk(c, F.get(f"__o_{n}", i)))), empty)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _octets(m: Column) -> Column:
    parts = F.split(F.regexp_replace(m, r"[^0-9]+", "."), r"\.")
    plain = lambda p: F.regexp_replace(p, "^0+", "")
    return (F.size(parts) == 4) & F.forall(parts, lambda p: (F.length(plain(p)) <= 3)
                                           & (F.lpad(plain(p), 3, "0") <= "255"))


def _luhn(m: Column) -> Column:
    n = F.length(_digits(m))
    return F.when((n >= 12) & (n <= 19), F.call_function("luhn_check", _digits(m))).otherwise(F.lit(False))


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``__base``: array of (s, k, e), k the number of the kind."""
    df = find(df, text, {f"__f_{k}": p for k, p in BASE.items()})
    checks = {"email": lambda m: F.lit(True), "ip": _octets, "card": _luhn,
              "phone": lambda m: F.length(_digits(m)).between(9, 15)}

    def passing(i, k):
        return F.transform(F.filter(f"__f_{k}", lambda x: checks[k](x["m"])),
                           lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e")))

    each = [passing(i, k) for i, k in enumerate(BASE)]
    return _step(df, __base=F.sort_array(F.concat(*each))).drop(*[f"__f_{k}" for k in BASE])


def _class(c: Column) -> Column:
    return (F.when(c.rlike(r"^\s?$"), 0).when(c.rlike(r"^\p{L}$"), 1).when(c.rlike("^[0-9]$"), 2).otherwise(3))


def _bin(n: Column, edges: tuple[int, ...]) -> Column:
    out = F.lit(0)
    for e in edges:
        out = out + F.when(n >= e, 1).otherwise(0)
    return out


def _iban(m: Column) -> Column:
    """Whether the remainder of 97 of an account number is right."""
    plain = F.translate(m, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.char_length(plain)), F.substring(plain, 1, 4))
    value = lambda c: F.when(c.rlike("[A-Z]"), F.ascii(c) - 55).otherwise(c.try_cast("int"))
    rest = F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), lambda a, c: F.pmod(
        a * F.when(c.rlike("[A-Z]"), 100).otherwise(10) + F.coalesce(value(c), F.lit(0)), F.lit(97)))
    return F.char_length(plain).between(15, 34) & (rest == 1)


def _verified(gen: int, m: Column, over_phone: Column) -> Column:
    """The label of a candidate of one generator."""
    kind = GENERATORS[gen][0]
    plain = F.translate(m, " ", "")
    if kind == "email":
        whole = F.regexp_replace(F.regexp_replace(plain, r"\(at\)|\[at\]", "@"), r"\(dot\)|\[dot\]", ".")
        return whole.rlike(rf"\A[{_LOCAL}]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{{2,24}}\z")
    if kind == "ip":
        return F.coalesce(_octets(m), F.lit(False))
    if kind == "card":
        return _luhn(m)
    if kind == "account":
        return _iban(m)
    if GENERATORS[gen][1].startswith(r"(?<![0-9])00"):
        digits = F.substring(_digits(m), F.lit(3), F.char_length(m))
        return digits.rlike("^[1-9]") & F.char_length(digits).between(9, 15) & (
            F.size(F.array_distinct(F.split(digits, ""))) >= 4)
    return over_phone


def candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``__cand``: array of (s, e, hit, over, features), ``hit`` the
    label of the candidate, ``over`` whether it overlaps a base span."""
    names = {f"__cand{i}": p for i, (_, p) in enumerate(GENERATORS)}
    df = find(df, text, names)

    def proposed(i, n):
        return F.transform(n, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"),
                                                 F.lit(i).alias("gen")))

    raw = F.concat(*[proposed(i, n) for i, n in enumerate(names)])
    df = _step(df, __raw=raw).drop(*names)

    def described(x):
        m, d = x["m"], _digits(x["m"])
        left = F.substring(F.col(text), F.greatest(x["s"] - 24, F.lit(0)) + 1, F.least(x["s"], F.lit(24)))
        context = F.lit(0)
        for i, rx in reversed(list(enumerate(CONTEXT))):
            context = F.when(left.rlike(rx), i + 1).otherwise(context)
        feature = dict(zip(FEATURES, (
            x["gen"], _bin(F.length(d), (1, 7, 9, 12, 16, 17)),
            _bin(F.length(m) - F.length(F.translate(m, " .-()[]", "")), (1, 2, 3, 4, 6)),
            _bin(F.size(F.array_distinct(F.split(d, ""))), (2, 4, 6)),
            _class(F.substring(F.col(text), x["s"], F.when(x["s"] > 0, 1).otherwise(0))),
            _class(F.substring(F.col(text), x["e"] + 1, F.lit(1))), context, _bin(F.length(m) - F.length(F.translate(m, ".", "")), (1, 2, 3)),
            _bin(F.length(m), (8, 12, 16, 20, 28)))))
        meets = lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])
        over = F.exists("__base", meets)
        phone = F.exists("__base", lambda b: meets(b) & (b["k"] == KINDS.index("phone")))
        hit = F.lit(False)
        for i in range(len(GENERATORS)):
            hit = F.when(x["gen"] == i, _verified(i, m, phone)).otherwise(hit)
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), hit.alias("hit"), over.alias("over"),
                        *[v.cast("int").alias(k) for k, v in feature.items()])

    return _step(df, __cand=F.transform("__raw", described)).drop("__raw")


class Trees:
    """Boosted depth-two trees over binned features, fitted on weighted cells."""

    def __init__(self, start: float = 0.0):
        self.start, self.trees = start, []  # tree: (f, cut, (f, cut, a, b), (f, cut, a, b))

    def margin(self, x: dict) -> float:
        total = self.start
        for f, cut, low, high in self.trees:
            g, c, a, b = low if x[f] < cut else high
            total += a if x[g] < c else b
        return total

    def expression(self, x: Column) -> Column:
        total = F.lit(self.start)
        for f, cut, low, high in self.trees:
            leaf = lambda s: F.when(x[s[0]] < s[1], s[2]).otherwise(s[3])
            total = total + F.when(x[f] < cut, leaf(low)).otherwise(leaf(high))
        return total

    @staticmethod
    def fit(cells: list[tuple[dict, float, float]]) -> Trees:
        """``cells``: features, weight of label 1 and of label 0."""
        one, zero = sum(c[1] for c in cells), sum(c[2] for c in cells)
        model = Trees(math.log((one + 0.5) / (zero + 0.5)))
        margins = [model.start] * len(cells)
        for _ in range(ROUNDS):
            grad = []
            for (_, a, b), m in zip(cells, margins):
                p = 1 / (1 + math.exp(-max(-30.0, min(30.0, m))))
                grad.append((a - (a + b) * p, (a + b) * max(p * (1 - p), 1e-6), a + b))
            every = list(range(len(cells)))
            top = _split(cells, grad, every)
            if top is None:
                break
            f, cut = top[:2]
            sides = [[i for i in every if cells[i][0][f] < cut], [i for i in every if cells[i][0][f] >= cut]]
            leaves = []
            for side in sides:
                s = _split(cells, grad, side)
                leaves.append(s[:4] if s else (f, cut, *[_value(grad, side)] * 2))
            model.trees.append((f, cut, *leaves))
            for side, (g, c, a, b) in zip(sides, leaves):
                for i in side:
                    margins[i] += a if cells[i][0][g] < c else b
        return model


def _value(grad, rows) -> float:
    g, h = sum(grad[i][0] for i in rows), sum(grad[i][1] for i in rows)
    return RATE * g / (h + 1.0)


def _split(cells, grad, rows):
    """Best (feature, cut, low leaf, high leaf) of some cells, or None."""
    total = [sum(grad[i][k] for i in rows) for k in range(3)]
    best, found = 1e-6, None
    for f in FEATURES:
        by: dict[int, list[float]] = {}
        for i in rows:
            s = by.setdefault(cells[i][0][f], [0.0, 0.0, 0.0])
            for k in range(3):
                s[k] += grad[i][k]
        low = [0.0, 0.0, 0.0]
        for v in sorted(by)[:-1]:
            low = [a + b for a, b in zip(low, by[v])]
            high = [a - b for a, b in zip(total, low)]
            if min(low[2], high[2]) < LEAST_CHILD:
                continue
            gain = low[0] ** 2 / (low[1] + 1) + high[0] ** 2 / (high[1] + 1) - total[0] ** 2 / (total[1] + 1)
            if gain > best:
                best, found = gain, (f, v + 1, RATE * low[0] / (low[1] + 1), RATE * high[0] / (high[1] + 1))
    return found


def train(df: DataFrame) -> tuple[Trees, dict[int, float]]:
    """Trees, and per generator the least margin to accept, from ``__cand``
    and ``__half``.  One half of the texts fits, the other calibrates; rows of
    cells beyond the largest count as wrong ones above every threshold."""
    counted = stored(df.where(F.size("__cand") > 0).select(F.col("__half").alias("half"), F.explode("__cand").alias("x"))
                     .groupBy("half", *[F.col(f"x.{f}").alias(f) for f in FEATURES])
                     .agg(F.count_if("x.hit").alias("one"), F.count(F.lit(1)).alias("all")), "pii-cells")
    cells = counted.orderBy(F.desc("all"), "half", *FEATURES).limit(MAX_CELLS).collect()
    spare = {r["gen"]: float(r["n"]) for r in counted.where("half = 1").groupBy("gen").agg(F.sum("all").alias("n")).collect()}
    for r in cells:
        if r["half"] == 1:
            spare[r["gen"]] -= r["all"]
    rows = [(r["half"], {f: r[f] for f in FEATURES}, float(r["one"]), float(r["all"] - r["one"])) for r in cells]
    fitted = [r[1:] for r in rows if r[0] == 0]
    if not any(r[2] for r in rows) or not fitted:
        return Trees(), {}
    model, limits = Trees.fit(fitted), {}
    for g in range(len(GENERATORS)):
        held = sorted(((model.margin(x), a, b) for h, x, a, b in rows if h == 1 and x["gen"] == g),
                      key=lambda r: -r[0])
        one, every = 0.0, spare.get(g, 0.0)
        for i, (margin, a, b) in enumerate(held):
            one, every = one + a, every + a + b
            last = i + 1 == len(held) or held[i + 1][0] < margin
            if last and every >= LEAST_SUPPORT and one >= PRECISION * every:
                limits[g] = margin
    return model, limits


def personal_data(docs: DataFrame, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, all by default) with ``base`` and
    ``spans``: arrays of (s, k, e), ``k`` the number of the kind in ``KINDS``,
    by start and then kind.  Columns of ``docs`` with these two names are
    replaced."""
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("base", "spans")]
    rows = docs.withColumn("__t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = candidates(base_spans(rows, "__t"), "__t")
    # matched once: the fit and the result read what is written
    rows = stored(rows.select(*names, "__base", "__cand", F.pmod(F.xxhash64("__t"), F.lit(2)).alias("__half")), "pii")
    model, limits = train(rows)
    typed = "array<struct<s:int,k:int,e:int>>"
    added = F.array().cast(typed)
    if limits:
        def limit_of(x):
            out = F.lit(math.inf)
            for g, limit in limits.items():
                out = F.when(x["gen"] == g, limit - 1e-9).otherwise(out)
            return out

        def kind_of(x):
            out = F.lit(0)
            for g, (k, _) in enumerate(GENERATORS):
                out = F.when(x["gen"] == g, KINDS.index(k)).otherwise(out)
            return out

        good = F.transform(F.filter("__cand", lambda x: ~x["over"]), lambda x: F.struct(
            (-model.expression(x)).alias("o"), x["s"].alias("s"), kind_of(x).alias("k"), x["e"].alias("e"),
            limit_of(x).alias("l")))
        rows = _step(rows, __good=F.sort_array(F.filter(good, lambda x: -x["o"] >= x["l"])))
        # of overlapping candidates the better one
        added = F.aggregate("__good", F.array().cast(typed), lambda a, x: F.when(
            F.exists(a, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])), a).otherwise(
            F.array_append(a, F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))))
    return rows.select(*names, F.col("__base").alias("base"),
                       F.sort_array(F.concat("__base", added)).alias("spans"))


def joined(spans: str) -> Column:
    """``kind:start:end`` of each span, by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"),
                                                                  x["e"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of ``text_col`` replaced by ``mark``;
    overlapping spans are replaced together."""
    rows = personal_data(docs, text_col)
    text = F.col(text_col).cast("string")
    cut = F.aggregate("spans", F.struct(F.lit(0).alias("p"), F.lit("").alias("out")), lambda a, x: F.struct(
        F.greatest(a["p"], x["e"]).alias("p"),
        F.when(x["s"] < a["p"], a["out"]).otherwise(F.concat(
            a["out"], F.substring(text, a["p"] + 1, x["s"] - a["p"]), F.lit(mark))).alias("out")),
        lambda a: F.concat(a["out"], F.substring(text, a["p"] + 1, F.char_length(text))))
    return rows.withColumn("__cut", cut).select(
        *[F.col("__cut").alias(c) if c == text_col else F.col(c) for c in docs.columns if c in rows.columns])
