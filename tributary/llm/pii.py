"""Personal data: patterns propose, checksums confirm, context adjusts.

Everything is column expressions within the row, so texts are not shuffled.  A span
is (start, end, kind, score), in code points, end exclusive.  Base kinds are email,
ip, card (Luhn) and phone.  Further kinds, reported from a score of ``ACCEPT``:

* iban: 0.3, and 0.6 for a remainder of 1 modulo 97; as long as its country fixes, or
  for a country not listed here, up to the first end of a word that leaves 1;
* ssn: 0.3, and 0.4 for a word such as "social security" before it;
* tel (national form, without +): 0.2, and 0.4 for a word such as "phone" before it.

Context words are looked for in the ``NEAR`` code points before a span; they raise
the score of base spans too.

Cases: a null text is an empty one.  Rows stand each for itself.  An empty table
gives no rows.  Patterns never recurse by the length of a text: runs are matched as
plain character runs and cut afterwards.  ``redacted`` keeps all columns.
"""

from pyspark.sql import functions as F

from tributary.llm.columns import between, let, located

ACCEPT = 0.5
NEAR = 40
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "tel")

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# From the start of a run of such characters, or where the last match ended; labels
# go on up to two dots in a row, or a dot that nothing follows.
_EMAIL = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++\.{_LABEL}[A-Za-z0-9.-]*?"
    r"(?=\.\.|\.?(?![A-Za-z0-9.-]))"
)
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_DIGITS = r"[0-9][0-9\x20-]*[0-9]"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# How long the IBANs of a country are, blanks not counted; each place that may begin
# one is looked at, up to as many characters as 34 with a blank between any two.
_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_START = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])"
_FIXED = "|".join(
    rf"(?:{v.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, v in _LENGTHS.items()
)
_FIXED = rf"^(?:{_FIXED})(?![A-Za-z0-9])"
_LISTED = "|".join(_LENGTHS.values()).replace(" ", "|")
_OTHER = rf"^(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}(?![A-Za-z0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_TEL = r"(?<![0-9+().-])[(]?0[0-9][0-9\x20()/-]{5,14}[0-9](?![0-9])"

_CONTEXT = {
    "email": "mail|contact|write|reach",
    "ip": r"\bip\b|address|host|server",
    "card": "card|visa|mastercard|amex|credit|debit|payment",
    "phone": "phone|mobile|call|tel|fax|whatsapp",
    "iban": "iban|account|bank|transfer",
    "ssn": r"\bssn\b|social security",
    "tel": "phone|mobile|call|tel|fax|whatsapp",
}
_PRIOR = {
    "email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.3, "ssn": 0.3, "tel": 0.2,
}
_RAISE = {k: 0.4 if k in ("ssn", "tel") else 0.1 for k in KINDS}


def _digits(text):
    return F.regexp_replace(text, "[^0-9]", "")


def _ip(m):
    def small(part):
        plain = F.regexp_replace(part, "^0+", "")
        return _number(plain) <= 255

    return F.forall(F.split(m.text, r"\."), small)


def _number(digits):
    """The value of a short run of digits; an empty one is 0."""
    return F.when(F.length(digits) > 3, F.lit(1000)).otherwise(
        F.concat(F.lit("0"), F.substring(digits, 1, 3)).cast("int")
    )


def luhn(digits):
    """Whether the checksum of a string of digits is right."""

    def add(s, i):
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return s + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return total % 10 == 0


def mod97(text):
    """Whether letters and digits, the first four moved to the end, leave 1 of 97."""
    plain = F.regexp_replace(text, " ", "")

    def checked(x):
        turned = F.concat(F.substr(x, F.lit(5)), F.substring(x, 1, 4))

        def step(s, i):
            code = F.ascii(F.substr(turned, i, F.lit(1)))
            letter = code >= ord("A")
            return F.when(letter, s * 100 + code - 55).otherwise(s * 10 + code - 48) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(x)), F.lit(0), step) == 1

    return let(plain, checked)


def _ibans(text):
    """Places of IBANs, of the length that the country fixes if it is known."""

    def span(m, found):
        return F.struct(m.start.alias("start"), (m.start + F.char_length(found)).alias("end"), found.alias("text"))

    def at(m):
        def proposed(rest):
            def other(run):
                ends = F.transform(between(run, " "), lambda p: F.substr(run, F.lit(1), p.end))
                good = F.filter(ends, lambda x: F.length(F.regexp_replace(x, " ", "")) >= 15)
                return F.slice(F.filter(good, mod97), 1, 1)

            fixed = F.regexp_extract(rest, _FIXED, 0)
            return F.when(F.length(fixed) > 0, F.array(fixed)).otherwise(
                let(F.regexp_extract(rest, _OTHER, 0), other)
            )

        held = let(F.substr(text, m.start + 1, F.lit(68)), proposed)
        return F.transform(held, lambda found: span(m, found))

    return F.flatten(F.transform(located(text, _IBAN_START), at))


def _spans(text, found, kind, proof=None):
    """Spans of one kind with their scores."""

    def scored(m):
        from_ = F.greatest(m.start - NEAR, F.lit(0))
        before = F.lower(F.substr(text, from_ + 1, m.start - from_))
        score = F.lit(_PRIOR[kind]) + F.when(before.rlike(_CONTEXT[kind]), _RAISE[kind]).otherwise(0.0)
        if proof is not None:
            score = score + F.when(proof(m.text), 0.6).otherwise(0.0)
        return F.struct(
            m.start.alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            m.end.alias("end"),
            F.lit(kind).alias("kind"),
            F.least(F.round(score, 2), F.lit(1.0)).alias("score"),
        )

    return F.transform(found, scored)


_NONE = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def spans(text):
    """All spans in a text, by start, then by kind."""

    def in_text(t):
        none = F.array().cast(_NONE)

        def where(condition, found):
            return F.when(condition, found).otherwise(none)

        def many(m):
            return let(F.length(_digits(m.text)), lambda n: (n >= 12) & (n <= 19))

        # Runs of digits, blanks and hyphens, cut where two of these meet.
        runs = F.filter(located(t, _DIGITS), lambda m: F.length(m.text) >= 12)
        cards = F.flatten(
            F.transform(
                runs,
                lambda run: F.transform(
                    between(run.text, r"[\x20-]{2,}"),
                    lambda p: F.struct(
                        (run.start + p.start).alias("start"),
                        (run.start + p.end).alias("end"),
                        p.text.alias("text"),
                    ),
                ),
            )
        )
        cards = F.filter(cards, many)
        cards = F.filter(cards, lambda m: let(_digits(m.text), luhn))

        def dialled(m):
            return let(F.length(_digits(m.text)), lambda n: (n >= 9) & (n <= 15))

        digit = t.rlike("[0-9]{3}|[0-9]\\.[0-9]|[0-9][\\x20-][0-9]")
        base = [
            where(F.contains(t, F.lit("@")), _spans(t, located(t, _EMAIL), "email")),
            where(t.rlike(r"[0-9]\.[0-9]"), _spans(t, F.filter(located(t, _IP), _ip), "ip")),
            where(digit, _spans(t, cards, "card")),
            where(t.rlike(r"\+[0-9]"), _spans(t, F.filter(located(t, _PHONE), dialled), "phone")),
        ]
        more = [
            where(t.rlike("[A-Z]{2}[0-9]{2}"), _spans(t, _ibans(t), "iban", mod97)),
            where(t.rlike("[0-9]-[0-9]{2}-[0-9]"), _spans(t, located(t, _SSN), "ssn")),
            where(digit, _spans(t, located(t, _TEL), "tel")),
        ]
        more = [F.filter(x, lambda s: s.score >= ACCEPT) for x in more]
        return F.array_sort(F.concat(*base, *more))

    return let(F.coalesce(text, F.lit("")), in_text)


def found(docs, text="text", name="pii"):
    """``docs`` with a column of all spans of the text."""
    return docs.withColumn(name, spans(F.col(f"`{text}`").cast("string")))


def listed(held):
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(held, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ","
    )


def masked(text, held):
    """``text`` with each span, or run of overlapping spans, named by its first kind."""

    def merged(kept, s):
        last = F.element_at(kept, -1)
        grown = F.struct(
            last.start.alias("start"), F.greatest(last.end, s.end).alias("end"), last.kind.alias("kind")
        )
        return F.when(
            s.start < last.end,
            F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(grown)),
        ).otherwise(F.concat(kept, F.array(F.struct(s.start, s.end, s.kind))))

    first = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("kind")))

    def rebuilt(kept):
        def piece(s, i):
            after = F.coalesce(F.get(kept, i + 1).start, F.char_length(text))
            label = F.when(i > 0, F.concat(F.lit("["), F.upper(s.kind), F.lit("]"))).otherwise("")
            return F.concat(label, F.substr(text, s.end + 1, after - s.end))

        return F.array_join(F.transform(kept, piece), "")

    return F.when(F.size(held) > 0, let(F.aggregate(held, first, merged), rebuilt)).otherwise(text)


def redacted(docs, text="text"):
    """``docs`` with personal data masked in the text, all columns kept."""
    column = F.col(f"`{text}`").cast("string")
    return docs.withColumn(text, let(F.struct(column.alias("t"), spans(column).alias("s")),
                                     lambda x: masked(x.t, x.s)))
