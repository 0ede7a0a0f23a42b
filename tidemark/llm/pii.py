"""Personal data and secrets by candidate generation and gradient boosting, with DataFrame and SQL functions only.

Base spans follow fixed patterns and checks and always count. Further generators with high recall propose spans,
which overlap: secrets, account, card and identity numbers, obfuscated addresses, numbers without a country code.
Boosted trees score each proposal by its format and its context; a threshold per generator, calibrated on rows that
training didn't see, selects. A selected span that overlaps a base span is dropped, and of selected spans that
overlap, that of the generator listed first stays.

The trees are fitted on the documents themselves: the proposals in a bounded sample (`max_docs`), labelled by rules
that abstain where they can't tell: check digits, valid fields, what base spans say of the same place, and assignment to a
name. Kinds that a corpus lacks are learned from generated examples, whose number and seed are parameters; a rarer kind
of the corpus so isn't lost. Half of both, by hash, is kept from training for calibration. The trees are grown on the
driver from these few rows and become SQL expressions, so documents are read by one plan without a shuffle or Python.

Matches are found by Spark's regular expressions; places come from the lengths of the matches and of what is between
them. The patterns are written so that no text makes them take more than time in proportion to its length: repeats are
possessive or bounded and a match starts at the start of a run of its characters or where the last match ended. Spans
are merged by running maxima over chunks, so a text with very many stays cheap.

Defined results: a null text counts as empty (no spans); a null or repeated doc_id is passed through, a row for each
input row; an empty table gives an empty table, and its trees come from generated examples alone; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import named, texts

#: The kinds in the order in which they are listed, base kinds first.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "secret")

#: The patterns of the base kinds.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: What proposes further spans: (kind, what a text must have for it, pattern); of overlapping spans the first stays.
GENERATORS = (
    ("secret", r"[0-9]", r"(?<![A-Za-z0-9_+/.-])(?=[A-Za-z_+/-]{0,64}[0-9])[A-Za-z0-9_+/-]{16,}+={0,2}"),
    ("iban", r"[A-Z]{2}[0-9]{2}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("card", r"[0-9]{4}", r"(?<![0-9A-Za-z])[0-9]{4}(?:[ ._/-]?[0-9]{3,6}){2,3}(?![0-9A-Za-z])"),
    ("ssn", r"[0-9]{3}[- ][0-9]{2}", r"(?<![0-9A-Za-z-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9A-Za-z-])"),
    ("email", r"(?i)[\[({]at[\])}]", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?[\[({](?:at|AT)[\])}] ?[A-Za-z0-9-]{1,63}+(?: ?(?:[\[({](?:dot|DOT)[\])}]|\.) ?[A-Za-z0-9-]{2,63}+){1,4}+"),
    ("phone", r"[0-9]{2}", r"(?<![0-9A-Za-z+.(/-])\(?[0-9]{2,5}\)?(?:[ ./-]{1,2}[0-9]{2,5}){2,4}(?![0-9A-Za-z])"),
)

#: Words before a span that speak for or against it.
CUES = {
    "phone": r"(?i)\b(?:phone|tel|telephone|telefon|tél|call|mobile|móvil|handy|fax|cell|whatsapp|sms|teléfono)\b\W{0,3}",
    "email": r"(?i)\b(?:e-?mail|mail|contact|write to|correo|courriel|kontakt|reach)\b",
    "account": r"(?i)\b(?:iban|account|konto|compte|cuenta|bank|bic)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)\b",
    "identity": r"(?i)\b(?:ssn|social|security|identity|national id|tax id|passport)\b",
    "secret": r"(?i)(?:token|secret|api.?key|access.?key|passw(?:or)?d|passwort|pwd|credential|bearer|auth)\b\W{0,6}$",
    "other": r"(?i)\b(?:order|invoice|version|isbn|issn|page|pages|price|total|ref|no|nr|sku|serial|build|date|figure|table|chapter|ratio|score|lot|part)\b",
}

CONTEXT = 40
CHUNK = 512
SMALL = 64


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value made once however often it is used; what use gives is an array."""
    return F.flatten(F.transform(F.array(value), use))


def largest_before(values: Column, least: int = -1) -> Column:
    """For each element of an array of whole numbers the largest of those before it; `least` if there is none.

    By chunks, so that the time grows little faster than the array.
    """

    def run(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(SMALL))
        chunks = F.transform(starts, lambda at: F.slice(v, at + 1, SMALL))

        def within(p: Column) -> Column:
            reached = F.aggregate(p, F.array(F.lit(least)), lambda acc, c: F.array_append(acc, F.greatest(F.element_at(acc, -1), F.array_max(c))))
            return F.flatten(_once(reached, lambda r: F.transform(p, lambda c, i: F.transform(c, lambda x, j: F.greatest(F.get(r, i), F.coalesce(F.array_max(F.slice(c, F.lit(1), j)), F.lit(least)))))))

        return F.when(F.size(v) > 0, _once(chunks, within)).otherwise(F.array().cast("array<int>"))

    return _once(values, run)


def matches(text: Column, pattern: str) -> Column:
    """Every match as (start, end, value, before, after), in code points from 0; before and after: what is around.

    Places are summed within chunks of matches and over the chunks, so that a text with very many stays cheap.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    packed = F.struct(found.alias("hit"), F.when(F.size(found) > 0, gaps).alias("gap"))

    def placed(p: Column) -> Column:
        hit, gap = p["hit"], p["gap"]
        lengths = F.zip_with(F.slice(gap, F.lit(1), F.size(hit)), hit, lambda g, h: F.struct(g.alias("g"), F.char_length(g).alias("before"), h.alias("h"), F.char_length(h).alias("own")))

        def cut(own: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), F.size(own) - 1, F.lit(CHUNK)), lambda at: F.slice(own, at + 1, CHUNK))

        def summed(chunks: Column) -> Column:
            sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda acc, x: acc + x["before"] + x["own"]))
            return F.aggregate(sums, F.array(F.lit(0)), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))

        def within(c: Column, start_at: Column) -> Column:
            zero = F.struct(start_at.alias("at"), F.array().cast("array<struct<start:int,end:int,value:string,before:string>>").alias("out"))

            def step(acc: Column, x: Column) -> Column:
                start = acc["at"] + x["before"]
                one = F.struct(start.alias("start"), (start + x["own"]).alias("end"), x["h"].alias("value"), F.substring(x["g"], -CONTEXT, CONTEXT).alias("before"))
                return F.struct((start + x["own"]).alias("at"), F.array_append(acc["out"], one).alias("out"))

            return F.aggregate(c, zero, step, lambda acc: acc["out"])

        def each(chunks: Column) -> Column:
            return F.flatten(_once(summed(chunks), lambda offsets: F.transform(chunks, lambda c, i: within(c, F.get(offsets, i)))))

        own = _once(lengths, lambda ls: _once(cut(ls), each))
        after = F.transform(F.slice(gap, F.lit(2), F.size(hit)), lambda g: F.substring(g, 1, 1))
        return F.zip_with(own, after, lambda o, a: F.struct(o["start"].alias("start"), o["end"].alias("end"), o["value"].alias("value"), o["before"].alias("before"), a.alias("after")))

    none = F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")
    # a one-element transform keeps the match arrays from being made again by each use
    return F.flatten(F.transform(F.array(packed), lambda p: F.when(F.size(p["hit"]) > 0, placed(p)).otherwise(none)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.char_length(number)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(F.reverse(number), i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 0, doubled).otherwise(d)

    return (n > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0)


def _passes(kind: str, value: Column) -> Column:
    own, n = digits(value), F.char_length(digits(value))
    if kind == "ip":
        def small(part: Column) -> Column:
            # a part may have any number of leading zeros
            short = F.regexp_replace(part, "^0+(?=[0-9])", "")
            return (F.char_length(short) <= 3) & (F.substring(short, 1, 3).cast("int") <= 255)

        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return n.between(12, 19) & F.when(n.between(12, 19), luhn(own)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each base kind: leftmost matches that don't overlap, without those that fail their check."""
    needs = {"email": "@", "ip": ".", "phone": "+"}
    out = {}
    for kind, pattern in BASE.items():
        source = F.when(F.contains(text, F.lit(needs[kind])), text).otherwise(F.lit("")) if kind in needs else text
        out[kind] = _checked(kind, matches(source, pattern))
    return out


def _checked(kind: str, found: Column) -> Column:
    return F.filter(found, lambda m: _passes(kind, m["value"]))


def mod97(value: Column) -> Column:
    """Whether an account number's letters and digits leave 1 when divided by 97, its first four put last."""
    own = F.regexp_replace(value, "[^0-9A-Z]", "")
    turned = F.split(F.concat(F.substring(own, 5, 1000), F.substring(own, 1, 4)), "")
    number = lambda c: F.when(c == "", F.lit(None).cast("int")).when(c <= "9", F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda acc, n: F.when(n.isNull(), acc).when(n < 10, acc * 10 + n).otherwise(acc * 100 + n) % 97
    return F.aggregate(F.transform(turned, number), F.lit(0), step) == 1


def features(generator: Column | int, value: Column, before: Column, after: Column) -> dict[str, Column]:
    """Format and context of a proposal, as numbers."""
    n = F.char_length(value)
    own = digits(value)
    n_digits = F.char_length(own)
    fields = ~F.rlike(own, F.lit("^(?:000|666|9)|^...00|0000$"))
    number = lambda c: c.cast("double")
    out = {
        "generator": number(F.lit(generator) if isinstance(generator, int) else generator),
        "length": number(n),
        "n_digits": number(n_digits),
        "digit_share": number(n_digits) / F.greatest(number(n), F.lit(1.0)),
        "n_groups": number(F.size(F.split(value, r"[^0-9A-Za-z]+"))),
        "has_space": number(F.contains(value, F.lit(" "))),
        "has_dash": number(F.contains(value, F.lit("-"))),
        "has_dot": number(F.contains(value, F.lit("."))),
        "has_slash": number(F.contains(value, F.lit("/"))),
        "has_parens": number(F.contains(value, F.lit("("))),
        "leading_zero": number(F.startswith(own, F.lit("0"))),
        "luhn": number(F.when(n_digits.between(12, 19), luhn(own)).otherwise(F.lit(False))),
        "mod97": number(F.when(F.rlike(value, F.lit("^[A-Z]{2}[0-9]{2}")), mod97(value)).otherwise(F.lit(False))),
        "valid_fields": number(fields & (n_digits == 9)),
        "changes": number(F.size(F.split(value, r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"))),
        "distinct": number(F.size(F.array_distinct(F.split(F.lower(value), "")))),
        "hexadecimal": number(F.rlike(value, F.lit("^[0-9a-fA-F]+$"))),
        "like_date": number(F.rlike(value, F.lit(r"^(?:(?:19|20)[0-9]{2}[-/. ][0-9]{2}[-/. ][0-9]{2}|[0-9]{2}[-/. ][0-9]{2}[-/. ](?:19|20)[0-9]{2})"))),
        "starts_line": number(F.rlike(before, F.lit(r"(?:^|\n)[ \t]*$"))),
        "quoted": number(F.rlike(before, F.lit("[\"'=]$"))),
        "ends_word": number(F.rlike(after, F.lit(r"^(?:$|[\s,.;:!?)\]]$)"))),
    }
    return out | {f"cue_{k}": number(F.rlike(before, F.lit(p))) for k, p in CUES.items()}


@dataclass(frozen=True)
class Boosted:
    """Trees as nested (feature, threshold, left, right) or leaf values, and thresholds by generator.

    report: by generator its kind and, of the labelled proposals in documents kept from training, how many there are,
    how many are right, and the precision and recall of the selection; None where there is nothing to divide by.
    """

    trees: tuple
    thresholds: tuple[float, ...] = ()
    report: tuple[tuple, ...] = ()

    def margin(self, f: dict[str, Column]) -> Column:
        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            name, at, left, right = node
            return F.when(f[name] <= at, value(left)).otherwise(value(right))

        total = F.lit(0.0)
        for tree in self.trees:
            total = total + value(tree)
        return total

    def probability(self, f: dict[str, Column]) -> Column:
        return 1 / (1 + F.exp(-2 * self.margin(f)))


def grown(x, y, names: list[str], n_trees: int, depth: int, rate: float = 0.4, ridge: float = 1.0, least: int = 8, n_cuts: int = 32) -> tuple:
    """Trees of boosted logistic regression (second-order gains), each as nested tuples; margins add up to half the log odds."""
    import numpy as np

    cuts = []
    for column in x.T:
        own = np.unique(column)
        own = own if len(own) <= n_cuts else np.unique(np.quantile(own, np.linspace(0, 1, n_cuts)))
        cuts.append((own[1:] + own[:-1]) / 2)
    bins = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], axis=1)
    margin, trees = np.zeros(len(y)), []

    def node(rows, g, h, level: int):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None, None)
        for j in range(x.shape[1] if level < depth and len(rows) >= 2 * least else 0):
            if not len(cuts[j]):
                continue
            sums = [np.cumsum(np.bincount(bins[rows, j], w, len(cuts[j]) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows)))]
            gain = sums[0] ** 2 / (sums[1] + ridge) + (total_g - sums[0]) ** 2 / (total_h - sums[1] + ridge) - total_g**2 / (total_h + ridge)
            gain[(sums[2] < least) | (len(rows) - sums[2] < least)] = -1
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], j, at)
        if best[1] is None:
            value = float(rate * total_g / (total_h + ridge))
            margin[rows] += value
            return value
        _, j, at = best
        low = bins[rows, j] <= at
        return names[j], float(cuts[j][at]), node(rows[low], g, h, level + 1), node(rows[~low], g, h, level + 1)

    for _ in range(n_trees if len(y) else 0):
        p = 1 / (1 + np.exp(-2 * margin))
        trees.append(node(np.arange(len(y)), y - p, 2 * p * (1 - p), 0))
    return tuple(trees)


def examples(spark: SparkSession, n: int, seed: int) -> DataFrame:
    """(generator, value, before, after, label): generated proposals; the label is by how each was made."""
    at = {kind: i for i, (kind, _, _) in enumerate(GENERATORS)}
    r = lambda k, m: F.pmod(F.xxhash64(F.lit(seed), F.lit(k), "id"), F.lit(m))
    d = lambda k, w: F.lpad(r(k, 10**w).cast("string"), w, "0")
    field = lambda k, most, w: F.lpad((1 + r(k, most)).cast("string"), w, "0")
    pick = lambda k, xs: F.get(F.lit(list(xs)), r(k, len(xs)).cast("int"))
    sep = pick("sep", [" ", "-", ".", "/"])
    letters = pick("let", ["ABCD", "QXYZ", "BANK", "KLMN", "WEST"])
    joint = pick("joint", ["", "", " ", "-", "."])
    card = F.concat(d("c1", 4), joint, d("c2", 4), joint, d("c3", 4), joint, d("c4", 3))
    odd = F.aggregate(F.sequence(F.lit(1), F.lit(15)), F.lit(0), lambda acc, i: acc + F.when(i % 2 == 1, F.when(F.substring(F.reverse(digits(card)), i, F.lit(1)).cast("int") > 4, 2 * F.substring(F.reverse(digits(card)), i, F.lit(1)).cast("int") - 9).otherwise(2 * F.substring(F.reverse(digits(card)), i, F.lit(1)).cast("int"))).otherwise(F.substring(F.reverse(digits(card)), i, F.lit(1)).cast("int")))
    right_card, wrong_card = (F.concat(card, ((10 - odd % 10 + shift) % 10).cast("string")) for shift in (0, 3))
    phone_cue, mail_cue, bank_cue = ["call me at ", "phone: ", "Tel. ", "mobile ", "fax "], ["e-mail ", "mail: ", "contact "], ["IBAN ", "account ", "bank: "]
    card_cue, id_cue = ["card ", "visa: ", "credit card "], ["SSN ", "social security ", "tax id "]
    other_cue = ["order ", "invoice no ", "version ", "isbn ", "pages ", "total ", "ref ", "serial ", "date "]
    plain = ["the house and ", "", "was then ", "= \"", "\n"]
    made = [  # generator, value, what stands before, label
        (at["phone"], F.concat(F.lit("("), d("p1", 3), F.lit(") "), d("p2", 3), F.lit("-"), d("p3", 4)), phone_cue, 1),
        (at["phone"], F.concat(F.lit("0"), d("p4", 3), sep, d("p5", 3), sep, d("p6", 4)), phone_cue, 1),
        (at["phone"], F.concat(F.lit("20"), d("y", 2), sep, d("m", 2), sep, d("dd", 2)), other_cue + plain, 0),
        (at["phone"], F.concat(d("n1", 3), sep, d("n2", 3), sep, d("n3", 3)), other_cue, 0),
        (at["phone"], F.concat(d("b1", 4), sep, d("b2", 4), sep, d("b3", 4), sep, d("b4", 4), sep, d("b5", 2)), bank_cue + plain, 0),
        (at["phone"], F.concat(d("n4", 2), sep, d("n5", 3), sep, d("n6", 4)), plain, 0),
        (at["email"], F.concat(pick("u", ["ann.lee", "jo_b", "m.ruiz", "k2"]), F.lit(" (at) "), pick("h", ["mail", "web-site", "post"]), F.lit(" (dot) com")), mail_cue + plain, 1),
        (at["email"], F.concat(pick("u", ["meet", "look", "us"]), F.lit(" (at) "), pick("h", ["noon", "five", "home"]), F.lit(". then")), ["we ", "they ", "let "], 0),
        (at["ssn"], F.concat(field("s1", 665, 3), F.lit("-"), field("s2", 99, 2), F.lit("-"), field("s3", 9999, 4)), id_cue, 1),
        (at["ssn"], F.concat(d("s4", 3), pick("sd", ["-", " "]), d("s5", 2), pick("sd", ["-", " "]), d("s6", 4)), other_cue + plain, 0),
        (at["iban"], F.concat(pick("cc", ["DE", "FR", "ES", "GB"]), d("i0", 2), F.lit(" "), d("i1", 4), F.lit(" "), d("i2", 4), F.lit(" "), d("i3", 4), F.lit(" "), d("i4", 4), F.lit(" "), d("i5", 2)), bank_cue, 1),
        (at["iban"], F.concat(pick("cc", ["AB", "XY", "QZ"]), d("i6", 2), letters, d("i7", 4), letters), other_cue + plain, 0),
        (at["card"], right_card, card_cue + plain, 1),
        (at["card"], wrong_card, other_cue + plain + card_cue, 0),
        (at["card"], F.concat(d("k1", 4), d("k2", 4), d("k3", 4)), other_cue + plain, 0),
    ]
    hexes = F.lower(F.hex(F.unhex(F.substring(F.sha2(F.concat(d("h1", 9), d("h2", 9)), 256), 1, 40))))
    mixed = F.substring(F.translate(F.base64(F.unhex(F.sha2(d("h3", 9), 256))), "+/=", "xyz"), 1, 32)
    key_cue = ["token = \"", "secret: ", "api_key=", "password = '", "Authorization: Bearer ", "access key "]
    made += [
        (at["secret"], hexes, key_cue, 1),
        (at["secret"], mixed, key_cue, 1),
        (at["secret"], F.concat(pick("w", ["section", "chapter-of-the", "page/of/the/book", "release-notes"]), F.lit("-"), pick("w2", ["internationally", "considerations", "with/some/long/path"]), F.lit("-"), d("h4", 2)), plain + other_cue, 0),
        (at["secret"], F.concat(d("h5", 8), d("h6", 8)), plain + other_cue + card_cue, 0),
    ]
    template = r("template", len(made))
    options = [F.struct(F.lit(g).alias("generator"), v.alias("value"), F.concat(pick("pre", ["", "so it was. ", "and "]), pick("cue", cues)).alias("before"), pick("end", ["", " ", ".", ","]).alias("after"), F.lit(float(label)).alias("label")) for g, v, cues, label in made]
    chosen = options[-1]
    for i, option in reversed(list(enumerate(options[:-1]))):
        chosen = F.when(template == i, option).otherwise(chosen)
    return spark.range(0, n, 1, 1).select("id", chosen.alias("e")).select("id", "e.*")


def weak_label(generator: Column, value: Column, before: Column) -> Column:
    """1.0 or 0.0 by rules on a proposal in a document, null where they can't tell."""
    f = features(generator, value, before, F.lit(""))
    yes = lambda name: f[name] == 1
    rules = {
        "secret": [(yes("cue_secret") & (f["changes"] > 2), 1.0), ((f["changes"] == 1) | F.rlike(value, F.lit("/[^/]*/")), 0.0)],
        "iban": [(yes("mod97"), 1.0), (F.lit(True), 0.0)],
        "card": [(yes("luhn") & (f["n_digits"] >= 13), 1.0), (F.lit(True), 0.0)],
        "ssn": [(yes("cue_identity") & yes("valid_fields"), 1.0), (~yes("valid_fields") | yes("cue_other"), 0.0)],
        "email": [(F.rlike(value, F.lit("(?i)[\\[({]dot[\\])}]")), 1.0), (F.rlike(value, F.lit("[.] ")), 0.0)],
        "phone": [(yes("like_date") | yes("cue_other"), 0.0), (yes("cue_phone") | F.rlike(before, F.lit("\\+[0-9]{1,3}[ -]?$")), 1.0), (yes("luhn"), 0.0)],
    }
    label = F.lit(None).cast("double")
    for g, (kind, _, _) in enumerate(GENERATORS):
        one = F.lit(None).cast("double")
        for when, value_of in reversed(rules[kind]):
            one = F.when(when, value_of).otherwise(one)
        label = F.when(generator == g, one).otherwise(label)
    return label


def _proposals(text: Column) -> Column:
    """The matches of all generators, each with the generator's number."""

    def numbered(g: int, found: Column) -> Column:
        return F.transform(found, lambda m: F.struct(F.lit(g).alias("generator"), *(m[k].alias(k) for k in ("start", "end", "value", "before", "after"))))

    found = (matches(F.when(F.rlike(text, F.lit(needs)), text).otherwise(F.lit("")), pattern) for _, needs, pattern in GENERATORS)
    return F.concat(*(numbered(g, each) for g, each in enumerate(found)))


def fit(docs: DataFrame, *, max_docs: int = 10_000, n_examples: int = 4000, seed: int = 7, n_trees: int = 12, depth: int = 3, precision: float = 0.99, id_col: str = "doc_id", text_col: str = "text") -> Boosted:
    """Trees fitted on the proposals in about `max_docs` documents, chosen by a hash of their ids, and on generated ones.

    Even hashes train. With the others a threshold is set for each generator: the lowest score, 0.5 at least, at and
    above which the selection has the precision; a generator without any right proposal selects nothing.
    """
    import numpy as np

    spark, names = docs.sparkSession, list(features(0, F.lit(""), F.lit(""), F.lit("")))
    known = texts(docs, id_col, text_col)
    share = int(min(1.0, max_docs / max(docs.count(), 1)) * (1 << 30))
    some = known.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) <= share).where("text is not null and doc_id is not null").select("doc_id", "text")
    real = some.select("doc_id", F.explode(_proposals(F.col("text"))).alias("e")).select("doc_id", "e.generator", "e.value", "e.before", "e.after")
    real = real.withColumn("label", weak_label(F.col("generator"), F.col("value"), F.col("before"))).where("label is not null").dropDuplicates(["doc_id", "generator", "value"])
    # of a sample with very many proposals a hash keeps as many of each generator as can be learned from
    rank = F.row_number().over(Window.partitionBy("generator", "label").orderBy(F.xxhash64("doc_id", "value", "before")))
    real = real.withColumn("rank", rank).where(F.col("rank") <= n_examples).drop("rank")
    made = examples(spark, n_examples, seed).withColumnRenamed("id", "doc_id")
    rows = real.withColumn("real", F.lit(True)).unionByName(made.withColumn("real", F.lit(False)))
    own = features(F.col("generator"), F.col("value"), F.col("before"), F.col("after"))
    table = rows.select("real", (F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 1).alias("held_out"), "label", *(own[k].alias(k) for k in names)).toPandas()
    table = table.sort_values(list(table.columns))  # the same trees however the rows came
    x, y, held, of = (table[c].to_numpy(float) for c in (names, "label", "held_out", "generator"))
    trees = grown(x[held == 0], y[held == 0], names, n_trees, depth)
    p = 1 / (1 + np.exp(-2 * sum(_margins(tree, names, x) for tree in trees)))
    thresholds, report = [], []
    for g, (kind, _, _) in enumerate(GENERATORS):
        mine = (held == 1) & (of == g)
        scored, best, right = sorted(zip(p[mine], y[mine]), reverse=True), 1.1, 0.0
        for i, (score, label) in enumerate(scored):
            right += label
            if (i + 1 == len(scored) or scored[i + 1][0] < score) and right and right / (i + 1) >= precision:
                best = max(float(score) - 1e-9, 0.5)
        thresholds.append(best)
        mine &= table["real"].to_numpy(bool)
        chosen, true = mine & (p >= best), mine & (y == 1)
        report.append((kind, int(mine.sum()), int(true.sum()), *(round(float((chosen & true).sum() / n), 4) if (n := int(every.sum())) else None for every in (chosen, true))))
    return Boosted(trees, tuple(thresholds), tuple(report))


def _margins(tree, names: list[str], x):
    import numpy as np

    if isinstance(tree, float):
        return np.full(len(x), tree)
    name, at, left, right = tree
    return np.where(x[:, names.index(name)] <= at, _margins(left, names, x), _margins(right, names, x))


SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))


def find(docs: DataFrame, model: Boosted | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, _base, _spans): arrays of (start, kind, end), by start, then kind. kind: a place in KINDS."""
    known = texts(docs, id_col, text_col)
    return _with_spans(known, model or fit(known), "text", "_base", "_spans")


def _with_spans(docs: DataFrame, model: Boosted, text_col: str, base_out: str, spans_out: str) -> DataFrame:
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    base = F.array_sort(F.concat(*(_spans(found, kind) for kind, found in base_spans(text).items())))
    chosen = _selected(_proposals(text), model)

    def add(taken: Column, g: Column) -> Column:
        own = F.transform(F.filter("_tidemark_chosen", lambda x: x["generator"] == g), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
        return F.array_sort(F.concat(taken, free_of(own, taken)))

    # only the generators that have something selected, in their order
    every = F.aggregate(F.array_sort(F.array_distinct(F.transform("_tidemark_chosen", lambda x: x["generator"]))), named(base_out), add)
    return docs.withColumn(base_out, base).withColumn("_tidemark_chosen", chosen).withColumn(spans_out, every).drop("_tidemark_chosen")


def free_of(own: Column, taken: Column) -> Column:
    """The spans of an array that overlap none of another one, by the ends before each and the starts after it."""
    tag = lambda xs, mine: F.transform(xs, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), F.lit(mine).alias("mine")))
    far = 1 << 30

    def judged(p: Column) -> Column:
        reached = largest_before(F.transform(p, lambda x: F.when(x["mine"], -1).otherwise(x["end"])))
        ahead = F.reverse(largest_before(F.transform(F.reverse(p), lambda x: F.when(x["mine"], -far).otherwise(-x["start"])), -far))
        rows = F.zip_with(F.zip_with(p, reached, lambda x, r: F.struct(x.alias("x"), r.alias("r"))), ahead, lambda a, n: F.struct(a["x"].alias("x"), (a["x"]["mine"] & (a["r"] <= a["x"]["start"]) & (-n >= a["x"]["end"])).alias("keep")))
        return F.transform(F.filter(rows, lambda r: r["keep"]), lambda r: F.struct(r["x"]["start"].alias("start"), r["x"]["kind"].alias("kind"), r["x"]["end"].alias("end")))

    return _once(F.array_sort(F.concat(tag(own, True), tag(taken, False))), judged)


def _selected(proposed: Column, model: Boosted) -> Column:
    """(generator, start, kind, end) of the proposals that reach their generator's threshold."""
    kinds, least = F.lit([KINDS.index(kind) for kind, _, _ in GENERATORS]), F.lit(list(model.thresholds))

    def seen(m: Column) -> Column:
        own = features(m["generator"], m["value"], m["before"], m["after"])
        return F.struct(m["generator"].alias("at"), m["start"].alias("start"), m["end"].alias("end"), *(c.alias(k) for k, c in own.items()))

    def likely(x: Column) -> Column:
        return model.probability({k: x[k] for k in features(0, F.lit(""), F.lit(""), F.lit(""))}) >= F.get(least, x["at"])

    chosen = F.filter(F.transform(proposed, seen), likely)
    return F.transform(chosen, lambda x: F.struct(x["at"].alias("generator"), x["start"].alias("start"), F.get(kinds, x["at"]).alias("kind"), x["end"].alias("end")))


def shown(spans: str) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counts(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(docs: DataFrame, model: Boosted | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each span of the text replaced by its kind in brackets; spans that overlap are replaced as one.

    A null text stays null; other columns stay.
    """
    names = docs.columns
    found = _with_spans(docs, model or fit(docs, id_col=id_col, text_col=text_col), text_col, "_tidemark_base", "_tidemark_spans")
    text = named(text_col)

    def pieces(spans: Column) -> Column:
        # spans with the end of what is before them; a long text is cut into stretches of some spans, each cut once
        reached = largest_before(F.transform(spans, lambda s: s["end"]), 0)
        own = F.zip_with(spans, reached, lambda s, r: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), r.alias("reached")))
        stretches = _once(own, lambda o: F.transform(F.sequence(F.lit(0), F.size(o) - 1, F.lit(SMALL)), lambda at: F.slice(o, at + 1, SMALL)))

        def cut(part: Column) -> Column:
            first, last = F.element_at(part, 1)["reached"], F.element_at(part, -1)["start"]
            whole = F.struct(F.substring(text, first + 1, F.greatest(last - first, F.lit(0))).alias("text"), first.alias("first"))

            def piece(w: Column, s: Column) -> Column:
                tag = F.concat(F.lit("["), F.upper(F.get(F.lit(list(KINDS)), s["kind"])), F.lit("]"))
                return F.when(s["start"] < s["reached"], "").otherwise(F.concat(F.substring(w["text"], s["reached"] - w["first"] + 1, s["start"] - s["reached"]), tag))

            return F.array(F.array_join(_once(whole, lambda w: F.transform(part, lambda s: piece(w, s))), ""))

        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.array(F.concat(F.array_join(F.flatten(F.transform(stretches, cut)), ""), F.substring(text, end + 1, F.char_length(text))))

    new = F.when(F.size("_tidemark_spans") > 0, F.get(_once(F.col("_tidemark_spans"), pieces), F.lit(0))).otherwise(text)
    return found.select(*(new.alias(c) if c == text_col else named(c) for c in names))
