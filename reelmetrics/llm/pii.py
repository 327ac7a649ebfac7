"""Personal data by candidate gradient boosting, in DataFrame expressions alone.

Generators with a high recall propose overlapping spans of e-mail addresses, IP addresses,
payment cards and phone numbers. Each candidate is described by its format and its context,
boosted trees score it, and a threshold calibrated for its kind selects what is redacted. The
trees are grown on the driver from a small labelled table, whose candidates come from the same
expressions, and are compiled to one expression. Texts never leave Spark's own operators.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelmetrics.llm.common import id_text
from reelmetrics.llm.trees import Node, grow

KINDS = ("email", "ip", "card", "phone")

# Base patterns. They match what the plain forms in the comments match; the look-behinds and
# possessive quantifiers only keep a long run of characters from being tried from each of them.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# More candidates: spelled-out addresses, defanged and long IP addresses, and numbers that the
# base patterns miss as they run into their neighbours or lack the plus sign.
MORE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?(?:\[at\]|\(at\)|\{at\}|@| at ) ?[A-Za-z0-9-]++(?:(?: ?(?:\[dot\]|\(dot\)|\{dot\}) ?| dot |\.)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}+){3}|(?:[0-9A-Fa-f]{1,4}+:){7}[0-9A-Fa-f]{1,4}+)(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:[0-9]{12,19}+|[0-9]{4}([ .-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])",
    "phone": r"(?<![0-9A-Za-z.])(?:\+?[0-9]{1,2}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
# What a text must hold for a pattern to match at all, looked up before the pattern is tried: one
# of each group. Any match has these in it, so nothing is lost.
DOTS = ("[dot]", "(dot)", "{dot}", " dot ", ".")
NEEDS = {
    ("base", "email"): (("@",), (".",)), ("base", "phone"): (("+",),),
    ("more", "email"): (("@", "[at]", "(at)", "{at}", " at "), DOTS), ("more", "ip"): (("[.]", "(.)", "[dot]", "(dot)", ":"),),
}
# Words before a span that speak for its kind, and words that speak for another meaning.
SPEAKS_FOR = {
    "email": r"(?i)(?:mail|contact|write|reach|address|from|to)\W*$",
    "ip": r"(?i)(?:\bip|host|server|address|client|login|from|node)\W*$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|payment|paid|pan)\W*(?:no\.?|number)?\W*$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|whatsapp|dial|number|contact)\.?\W*$",
}
SPEAKS_AGAINST = r"(?i)(?:version|\bv|release|order|invoice|isbn|serial|\bid|ref|reference|case|ticket|section|build|sku|key|hash|token|password)\W*(?:no\.?|number)?\W*$"

FEATURES = ("kind", "more", "digits", "others", "luhn", "before", "after", "for_it", "against", "plus", "brackets", "parts", "spaced")

# The labelled table: forms of personal data in places that speak for it, say nothing, or speak
# against it, where only an address stays one; and forms that look alike and are nothing.
FORMS = {
    "email": (
        "anna.k@mail.example.com", "j_doe+x@example.org", "jo [at] example [dot] com", "kim (at) mail (dot) example (dot) org",
        "sam{at}example.net", "pat(at)example(dot)com", "nora at example dot com", "lee99 [at] mail.example.org",
        "jo @ example.com", "pat@example{dot}com",
    ),
    "ip": (
        "10.20.30.40", "192.168.4.77", "8.8.4.4", "198[.]51[.]100[.]7", "203(.)0(.)113(.)9", "172[dot]16[dot]0[dot]5",
        "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80:0000:0000:0000:0202:b3ff:fe1e:8329",
    ),
    "card": (
        "4539578763621486", "4485275742308327", "4716-1231-4435-8808", "5425 2334 3010 9903", "4532015112830366",
        "6011.0009.9013.9424", "5555.5555.5555.4444", "4012888888881881", "378282246310005", "30569309025904",
    ),
    "phone": (
        "(212) 555-0147", "415-555-0132", "646.555.0119", "+1 (303) 555-0175", "+44 20 7946 0958", "1-800-555-0199",
        "720 555 0163", "+49.30.901820.11", "+1 (704) 555-0123", "1 (617) 555-0108",
    ),
}
ALIKE = {
    "email": ("meet at noon dot it", "look at that dot com", "he is at home dot nobody"),
    "ip": ("4.10.0.256", "300.1.2.3", "00:1b:44:11:3a:b7:00:ff:12", "999[.]1[.]1[.]1"),
    "card": ("4539578763621487", "100200300400500", "9780306406158", "12345678901234", "1706659200000", "999000111222333441", "4111.2222.3333.4445", "a4539578763621486b",
        "1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "2 " * 59 + "2", "31415926535897932384626433832", "2024 2025 2026 2027 2028 2029 2030"),
    "phone": ("+1 2", "+2024 01 31 12 59 59 0001 77", "+12345678901234567"),
}
SAY_YES = {
    "email": ("mail {} today", "write to {} soon", "contact: {}, thanks"),
    "ip": ("server {} was down", "from {} then", "host {} seen"),
    "card": ("card no. {} expires", "paid with visa {} online", "credit {} charged"),
    "phone": ("call {} now", "phone: {}.", "fax {} or write"),
}
# An address whose only sign is the word "at" counts where the words before it speak for one.
UNMARKED = ("jo at example.com", "nora.w at mail.example.org", "kim7 at example.net")
NOT_MARKED = ("look at example.com", "arrived at 10.30", "stay at home.then", "sold at 4.99")
SAY_NOTHING = ("she saw {} there", "and {}, then", "so {}. End", "the last was {}")
SAY_NO = ("order {} shipped", "version {} is out", "token {} kept", "ref {} closed", "serial no. {} made")
# Two in a row, whose base patterns run into each other.
IN_A_ROW = ("at {phone} {card} both", "so {phone} {ip} and", "saw {card} {phone} there", "in {ip} {card} too")


def labelled() -> tuple[list[str], list[set[tuple[int, int, int]]]]:
    """Texts, and the spans of personal data in them: kind, begin, end."""
    texts, spans = [], []

    def say(pattern: str, *forms: tuple[str, str], true: bool = True) -> None:
        text, marked = "", set()
        for gap, (kind, form) in zip(re.split(r"\{\w*\}", pattern), [*forms, ("", "")], strict=True):
            text += gap
            if form and true:
                marked.add((KINDS.index(kind), len(text), len(text) + len(form)))
            text += form
        texts.append(text)
        spans.append(marked)

    for kind in KINDS:
        for form in FORMS[kind]:
            for pattern in (*SAY_YES[kind], *SAY_NOTHING):
                say(pattern, (kind, form))
            for pattern in SAY_NO:
                say(pattern, (kind, form), true=kind == "email")
        for form in ALIKE[kind]:
            for pattern in (*SAY_NOTHING, *SAY_NO):
                say(pattern, (kind, form), true=False)
    for form in UNMARKED:
        for pattern in SAY_YES["email"]:
            say(pattern, ("email", form))
    for form in NOT_MARKED:
        for pattern in (*SAY_NOTHING, *SAY_NO):
            say(pattern, ("email", form), true=False)
    for pattern in IN_A_ROW:
        kinds = re.findall(r"\{(\w+)\}", pattern)
        for i in range(5):
            say(pattern, *((k, FORMS[k][i]) for k in kinds))
    return texts, spans


def _class_of(char: Column) -> Column:
    """0: none, white space or a stop; 1: a letter; 2: a digit; 3: another sign."""
    return F.when(char.isNull() | (char == "") | char.rlike(r"[\s.,;!?]"), 0).when(char.rlike("[0-9]"), 2).when(char.rlike(r"\p{L}"), 1).otherwise(3)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, where ``value`` is worked out once however often it is named: an array of
    one holds it."""
    return F.transform(F.array(value), use)[0]


def luhn(digits: Column) -> Column:
    """Whether the check digit fits; false for a string without digits."""
    return once(digits, _luhn)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        double = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, double).otherwise(d)

    return (n > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0)


#: Elements that one fold goes over. A fold copies what it has gathered at each element, so long
#: arrays are folded block by block, which keeps the work about linear.
BLOCK = 256


def scan(items: Column, start: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """A fold that gives out elements: ``step`` maps state and item to the next state and an array
    of ``kind``. The result has the last ``state`` and the arrays in a row (``out``).

    ``items`` must be a column or variable, as it is read for every block.
    """
    none, nothing = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def add(done: Column, item: Column) -> Column:
        state, out = step(done["state"], item)
        return F.struct(state.alias("state"), F.concat(done["out"], out).alias("out"))

    def block(done: Column, k: Column) -> Column:
        start = F.struct(done["state"].alias("state"), none.alias("out"))
        return F.aggregate(
            F.slice(items, k * BLOCK + 1, BLOCK), start, add, lambda f: F.struct(f["state"].alias("state"), F.concat(done["out"], F.array(f["out"])).alias("out"))
        )

    blocks = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    blocks = F.when(F.size(items) > 0, blocks).otherwise(F.array().cast("array<int>"))
    return F.aggregate(blocks, F.struct(start.alias("state"), nothing.alias("out")), block, lambda d: F.struct(d["state"].alias("state"), F.flatten(d["out"]).alias("out")))


SPAN = "struct<kind:int,more:int,begin:int,end:int,match:string,before:string,after:string>"
SCORED = SPAN[:-1] + ",base:boolean,p:double>"


def found(text: Column, kind: str, more: bool, gated: bool = True) -> Column:
    """All matches of one generator: kind, more, begin, end, match, and the text before and after
    (up to the neighbouring match, 24 characters at most). Texts that hold none of what NEEDS
    names aren't searched if ``gated``."""
    pattern = (MORE if more else BASE)[kind]

    def add(at: Column, part: Column) -> tuple[Column, Column]:
        begin = at + F.length(part["gap"])
        end = begin + F.length(part["match"])
        span = F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            F.lit(int(more)).alias("more"),
            begin.alias("begin"),
            end.alias("end"),
            part["match"].alias("match"),
            F.substring(part["gap"], -24, 24).alias("before"),
            F.substring(part["next"], 1, 24).alias("after"),
        )
        return end, F.array(span)

    def spans_of(cut: Column) -> Column:
        n = F.size(cut["match"])
        parts = F.arrays_zip(F.slice(cut["gap"], 1, n).alias("gap"), cut["match"].alias("match"), F.slice(cut["gap"], 2, n).alias("next"))
        return once(parts, lambda p: scan(p, F.lit(0), SPAN, add)["out"])

    spans = once(F.struct(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match")), spans_of)
    needs = NEEDS.get(("more" if more else "base", kind))
    possible = reduce(lambda a, b: a & b, (reduce(lambda a, b: a | b, (text.contains(n) for n in group)) for group in needs)) if needs else text.rlike("[0-9]")
    return F.when(possible, spans).otherwise(F.array().cast(f"array<{SPAN}>")) if gated else spans


def islands(spans: Column) -> Column:
    """The spans by begin, in arrays that no span of another one overlaps."""
    # A struct compares by its fields in order: begin comes first.
    by_begin = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), s.alias("span"))))

    def add(state: Column, s: Column) -> tuple[Column, Column]:
        new = s["begin"] >= state["end"]
        none = F.array().cast(f"array<{SCORED}>")
        own = F.concat(F.when(new, none).otherwise(state["own"]), F.array(s["span"]))
        closed = F.when(new & (F.size(state["own"]) > 0), F.array(state["own"])).otherwise(F.array().cast(f"array<array<{SCORED}>>"))
        return F.struct(F.greatest(state["end"], s["end"]).alias("end"), own.alias("own")), closed

    start = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<{SCORED}>").alias("own"))
    done = once(by_begin, lambda b: scan(b, start, f"array<{SCORED}>", add))
    return once(done, lambda d: F.concat(d["out"], F.array(d["state"]["own"])))


def is_base(span: Column) -> Column:
    """Whether a match of a base pattern passes its kind's check."""
    digits = _digits(span["match"])
    n = F.length(digits)
    parts = F.forall(F.split(span["match"], r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    checks = [F.lit(True), parts, F.when(n.between(12, 19), luhn(digits)).otherwise(False), n.between(9, 15)]
    passed = reduce(lambda rest, k: F.when(span["kind"] == k, checks[k]).otherwise(rest), range(4), F.lit(False))
    return (span["more"] == 0) & passed


def features(span: Column) -> Column:
    """The description of a candidate, a struct of doubles named by FEATURES."""
    match, before = span["match"], span["before"]
    digits = _digits(match)
    speaks = reduce(lambda rest, k: F.when(span["kind"] == k, before.rlike(SPEAKS_FOR[KINDS[k]])).otherwise(rest), range(4), F.lit(False))
    octets = F.split(match, r"\.|\[\.\]|\(\.\)|\[dot\]|\(dot\)")
    values = (
        span["kind"],
        span["more"],
        F.length(digits),
        F.length(match) - F.length(digits),
        F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False).cast("int"),
        _class_of(F.substring(before, -1, 1)),
        _class_of(F.substring(span["after"], 1, 1)),
        speaks.cast("int"),
        before.rlike(SPEAKS_AGAINST).cast("int"),
        match.startswith("+").cast("int"),
        match.rlike(r"[\[({]").cast("int"),
        (F.when(span["kind"] == 1, F.forall(octets, lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))).otherwise(True)).cast("int"),
        # 1: "at" in brackets, or with the word "dot"; 2: the word "at" alone.
        F.when(match.rlike(r"(?i)^[^@]* at .* dot |^[^@]*[\[({]at[\])}]"), 1).when(match.rlike(r"(?i)^[^@]* at "), 2).otherwise(0),
    )
    return F.struct(*(v.cast("double").alias(n) for n, v in zip(FEATURES, values, strict=True)))


def candidates(text: Column, gated: bool = True) -> Column:
    return F.concat(*(found(text, kind, more, gated) for more in (False, True) for kind in KINDS))


class Boosted:
    """Boosted trees for the log odds, and the probability from which each kind is redacted."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 24, rate: float = 0.4, precision: float = 0.98, folds: int = 4):
        kinds = x[:, 0].astype(int)
        out = np.zeros(len(y))
        fold = np.arange(len(y)) * 7 // 3 % folds
        for k in range(folds):
            held = fold == k
            _, trees = self._grow(x[~held], y[~held], rounds, rate)
            start = self._start(y[~held])
            out[held] = [start + sum(self._value(t, row) for t in trees) for row in x[held]]
        self.held = odds = 1 / (1 + np.exp(-out))
        # The lowest threshold at which what was held out is right often enough.
        self.thresholds = []
        for k in range(len(KINDS)):
            p, own = odds[kinds == k], y[kinds == k]
            fits = [t for t in sorted({*p, 0.5}) if t > 0 and (own[p >= t].sum() + 1) / ((p >= t).sum() + 1) >= precision]
            self.thresholds.append(float(fits[0]) if fits else 0.9)
        self.start = self._start(y)
        _, self.trees = self._grow(x, y, rounds, rate)

    @staticmethod
    def _start(y: np.ndarray) -> float:
        return float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))

    @staticmethod
    def _value(tree: Node, row: np.ndarray) -> float:
        while tree.left is not None:
            tree = tree.left if row[tree.feature] <= tree.cut else tree.right
        return tree.value

    def _grow(self, x: np.ndarray, y: np.ndarray, rounds: int, rate: float) -> tuple[np.ndarray, list[Node]]:
        """Each tree fits Newton steps: gradient over curvature, weighted by the curvature."""
        score, trees = np.full(len(y), self._start(y)), []
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            curve = np.maximum(p * (1 - p), 1e-3)
            tree = self._scaled(grow(x, np.clip((y - p) / curve, -4, 4), 3, 2, curve), rate)
            score = score + np.array([self._value(tree, row) for row in x])
            trees.append(tree)
        return score, trees

    def _scaled(self, node: Node, rate: float) -> Node:
        if node.left is None:
            return Node(node.value * rate)
        return Node(node.value * rate, node.feature, node.cut, self._scaled(node.left, rate), self._scaled(node.right, rate))

    def probability(self, row: Column) -> Column:
        def compiled(node: Node) -> Column:
            if node.left is None:
                return F.lit(node.value)
            return F.when(row[FEATURES[node.feature]] <= node.cut, compiled(node.left)).otherwise(compiled(node.right))

        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, map(compiled, self.trees), F.lit(self.start))))

    def selects(self, span: Column, probability: Column) -> Column:
        return probability >= reduce(lambda rest, k: F.when(span["kind"] == k, self.thresholds[k]).otherwise(rest), range(4), F.lit(1.0))


def model(spark: SparkSession) -> Boosted:
    """The trees, grown from the labelled texts: their candidates, a few hundred rows, come to the driver."""
    texts, marked = labelled()
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    spans = rows.select("i", F.explode(candidates(F.col("text"))).alias("span")).select("i", "span", features(F.col("span")).alias("f")).collect()
    spans.sort(key=lambda r: (r["i"], r["span"]["more"], r["span"]["kind"], r["span"]["begin"]))
    x = np.array([[r["f"][n] for n in FEATURES] for r in spans])
    y = np.array([float((r["span"]["kind"], r["span"]["begin"], r["span"]["end"]) in marked[r["i"]]) for r in spans])
    return Boosted(x, y)


def _named(spans: Column) -> Column:
    """kind:begin:end of all spans by begin, then kind as listed, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["kind"].alias("kind"), s["end"].alias("end"))))
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["begin"], s["end"])), ",")


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", trees: Boosted | None = None) -> DataFrame:
    """doc_id, text, and two arrays of spans (kind: 0 to 3 as in KINDS, begin, end in code points,
    match) of every row: ``base`` and ``added``.

    Base spans are the matches of the base patterns that pass their checks. Added spans are
    candidates that the boosted trees select; one that overlaps a base span or a likelier
    candidate is left out, of ties the first. Null and empty texts have none. Repeated rows
    and null ids each give a row; other columns are not read. Nothing is shuffled.
    """
    trees = trees or model(docs.sparkSession)
    rows = id_text(docs, key, text).withColumn("all", candidates(F.col("text")))
    plain = ("kind", "begin", "end", "match")
    scored = F.transform("all", lambda s: s.withField("base", is_base(s)).withField("p", once(features(s), trees.probability)))
    rows = rows.withColumn("likely", F.when(F.size("all") == 0, F.array().cast(f"array<{SCORED}>")).otherwise(scored))

    def meets(a: Column, b: Column) -> Column:
        return (a["begin"] < b["end"]) & (b["begin"] < a["end"])

    def beats(o: Column, s: Column) -> Column:
        first = F.struct(o["begin"], o["kind"], o["end"]) < F.struct(s["begin"], s["kind"], s["end"])
        return meets(o, s) & ((o["p"] > s["p"]) | ((o["p"] == s["p"]) & first))

    # Only spans of one island overlap, so they are compared within it.
    chosen = F.filter("likely", lambda s: s["base"] | trees.selects(s, s["p"]))
    free = F.transform(islands(chosen), lambda own: F.filter(own, lambda s: ~F.exists(own, lambda b: b["base"] & meets(b, s))))
    rows = rows.withColumn("free", F.flatten(free))
    left = F.transform(islands(F.col("free")), lambda own: F.filter(own, lambda s: ~F.exists(own, lambda o: beats(o, s))))
    added = F.array_distinct(F.transform(F.flatten(left), lambda s: F.struct(*(s[n].alias(n) for n in plain))))
    base = F.transform(F.filter("likely", lambda s: s["base"]), lambda s: F.struct(*(s[n].alias(n) for n in plain)))
    return rows.select("doc_id", "text", base.alias("base"), added.alias("added"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", trees: Boosted | None = None) -> DataFrame:
    """doc_id and text of every row, each span of personal data replaced by its kind in brackets;
    overlapping spans become one, named by the first."""
    name = F.array(*(F.lit(k) for k in KINDS))

    def cut(state: Column, s: Column) -> Column:
        new = s["begin"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(new, F.concat(state["out"], F.substring(state["text"], state["at"] + 1, s["begin"] - state["at"]), F.lit("["), F.get(name, s["kind"]), F.lit("]")))
            .otherwise(state["out"])
            .alias("out"),
            state["text"].alias("text"),
        )

    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["begin"].alias("begin"), s["kind"].alias("kind"), s["end"].alias("end"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"), F.col("text").alias("text"))
    done = F.aggregate(spans, start, cut, lambda s: F.concat(s["out"], F.substring(s["text"], s["at"] + 1, F.length(s["text"]))))
    return find_spans(docs, key, text, trees).select("doc_id", F.when(F.size(spans) == 0, F.col("text")).otherwise(done).alias("text"))


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (counts of base spans), base_sha256, spans (base and
    added) and n_added of every row."""
    found_ = find_spans(docs, key, text)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return found_.select(
        "doc_id",
        *map(count, range(4)),
        F.sha2(_named(F.col("base")), 256).alias("base_sha256"),
        _named(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
