"""Column helpers: values used several times, and where patterns match."""

from pyspark.sql import functions as F

_BLOCK = 64


def let(value, body):
    """``body`` of ``value``, which is worked out once however often it is used."""
    return F.transform(F.array(value), body)[0]


def _before(lengths):
    """For each element the sum of those before it, in time near linear."""
    last = F.ceil(F.size(lengths) / _BLOCK).cast("int") - 1

    def of_blocks(blocks):
        def at(_, k):
            block = F.floor(k / _BLOCK).cast("int")
            inside = F.slice(lengths, block * _BLOCK + 1, k - block * _BLOCK)
            return F.get(blocks, block) + F.aggregate(inside, F.lit(0), lambda s, x: s + x)

        return F.transform(lengths, at)

    def block_sum(b):
        part = F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))
        return F.aggregate(part, F.lit(0), lambda s, x: s + x)

    empty = F.array(F.lit(0))
    sums = F.when(last > 0, F.transform(F.sequence(F.lit(0), last - 1), block_sum)).otherwise(
        F.array().cast("array<int>")
    )
    starts = F.aggregate(
        sums, empty, lambda held, x: F.concat(held, F.array(F.element_at(held, -1) + x))
    )
    return F.when(F.size(lengths) > 0, let(starts, of_blocks)).otherwise(
        F.array().cast("array<int>")
    )


def _parts(text, pattern, body):
    """``body`` of pieces, matches and the places where the pieces begin."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)

    def with_starts(both):
        def length(p, k):
            return F.char_length(p) + F.coalesce(F.char_length(F.get(both.m, k)), F.lit(0))

        lengths = F.transform(both.p, length)
        return let(let(lengths, _before), lambda starts: body(both.p, both.m, starts))

    return let(F.struct(pieces.alias("p"), matches.alias("m")), with_starts)


def _span(start, text):
    return F.struct(start.alias("start"), (start + F.char_length(text)).alias("end"), text.alias("text"))


def located(text, pattern):
    """All matches of ``pattern``: start, end (code points) and text."""

    def body(pieces, matches, starts):
        return F.transform(
            matches,
            lambda m, k: _span(F.get(starts, k) + F.char_length(F.get(pieces, k)), m),
        )

    return _parts(text, pattern, body)


def between(text, pattern):
    """What lies between the matches of ``pattern``: start, end and text."""
    return _parts(
        text, pattern, lambda p, _, starts: F.transform(p, lambda x, k: _span(F.get(starts, k), x))
    )
