"""Column expressions over text.  All run in the JVM."""

from pyspark.sql import functions as F

#: What a Python 2 unicode ``strip()`` takes for white space (fixed value).
BLANKS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"

#: Pattern of the tags that carry a link or an image (fixed value).  The group
#: of the address is greedy, so the last href/src of a tag wins.
TAG_PATTERN = r'(?i)<\s*(a|img)\s*[^>]*(?:(?:href|src)\s*=\s*"([^"]+))"[^>]*>'
BARE_URL_PATTERN = r"(https?://[^\s]+)"
ANY_TAG_PATTERN = r"<[^>]*>"
RETWEET_PATTERN = r"(?i)^(RT:?)\s*"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: ASCII word characters.  One by one in a class, they are a table to Java, not ranges.
WORD_CHARACTERS = UPPER + LOWER + "0123456789_"

#: Fixed value: longest term the registry takes.
MAX_TERM = 60

#: Where a run of ASCII word characters begins or ends, in folded text.
RUN_EDGE = r"(?<=[a-z0-9_])(?![a-z0-9_])|(?<![a-z0-9_])(?=[a-z0-9_])"


def strip(text):
    """Cut white space at both ends as Python does, not blanks only."""
    return F.regexp_replace(text, f"^{BLANKS}+|{BLANKS}+$", "")


def md5_text(*parts):
    """FN-1: md5 of the parts joined, a missing part counting as ''."""
    return F.md5(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]))


def sha256_hex(value):
    """FN-2."""
    return F.sha2(value, 256)


def filled(text):
    """True for text that is neither NULL nor empty."""
    return F.coalesce(F.length(text) > 0, F.lit(False))


def strip_tags(text):
    """FN-9."""
    return strip(F.regexp_replace(text, ANY_TAG_PATTERN, ""))


def bare_urls(text):
    """FN-10: addresses left in the text once tags are gone."""
    return F.regexp_extract_all(strip_tags(text), F.lit(BARE_URL_PATTERN), F.lit(1))


def tag_urls(text):
    """FN-8: array of (tag, url) of every ``<a>``/``<img>`` with an address."""
    pattern = F.lit(TAG_PATTERN)
    found = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(1)).alias("tag"),
        F.regexp_extract_all(text, pattern, F.lit(2)).alias("url"),
    )
    return F.transform(
        found, lambda x: F.struct(F.lower(x["tag"]).alias("tag"), x["url"].alias("url"))
    )


def line_breaks(text):
    """FN-23: newlines become HTML line breaks."""
    return F.replace(text, F.lit("\n"), F.lit("<br>\n"))


def local_part(address):
    """FN-22: the part of a mail address before the first ``@``."""
    return F.split_part(address, F.lit("@"), F.lit(1))


def comment_token(address):
    """FN-22: local part with the comment prefix cut."""
    return F.regexp_replace(local_part(address), r"^(drop|bucket)-comment-", "")


def plain_ampersands(url):
    """FN-7."""
    return F.replace(url, F.lit("&amp;"), F.lit("&"))


def normal_terms(value):
    """FN-20: the clean terms of one option value (Q-8: none of them empty)."""
    cleaned = F.transform(
        F.split(value, ","),
        lambda t: F.regexp_replace(strip(F.lower(t)), "^@?#?", ""),
    )
    return F.filter(cleaned, lambda t: t != "")


def predicate_type(key):
    """FN-21."""
    return F.when(F.lower(key).isin("person", "user"), "follow").otherwise("track")


def fold_ascii(text):
    """Lower-case A-Z only, as a case-blind match without Unicode rules does."""
    return F.translate(text, UPPER, LOWER)


def term_tokens(term):
    """The distinct tokens a track term asks for (Q-7: none of them empty)."""
    tokens = F.split(fold_ascii(term), r"\s+")
    return F.array_distinct(F.filter(tokens, lambda t: t != ""))


#: Signs of a chunk that a token, with a sign on either side, is sought in at once.
#: Windows overlap by more than the longest token needs.
_STEP = MAX_TERM + 4
_WIDTH = 2 * _STEP
_RUNS = f"([{WORD_CHARACTERS}]+|[^{WORD_CHARACTERS}]+)"


def _windows(folded):
    """``folded`` in overlapping windows: (piece, context) each.

    The context of a window that cuts the chunk goes on with signs that no token
    holds and that make no edge: so many word characters that no token is as long, or
    a blank beside a symbol.  A token and the signs around it lie whole in some window.
    """
    filler = F.lit("_" * (MAX_TERM + 1))

    def beyond(sign):
        return F.when(sign.rlike("[a-z0-9_]"), filler).otherwise(F.lit(" "))

    def window(piece, k):
        before = F.when(k > 0, beyond(F.left(piece, F.lit(1)))).otherwise("")
        # A shorter piece reaches the end; a whole one is followed by another that does.
        cut = F.char_length(piece) == _WIDTH
        after = F.when(cut, beyond(F.right(piece, F.lit(1)))).otherwise("")
        return F.struct(piece.alias("piece"), F.concat(before, piece, after).alias("context"))

    # One pass: each match takes a step and looks a whole width ahead.
    pattern = f"(?s)(?=(.{{1,{_WIDTH}}})).{{1,{_STEP}}}"
    return F.transform(F.regexp_extract_all(folded, F.lit(pattern), F.lit(1)), window)


def match_keys(chunk):
    """The (key, context) under which a token with symbols that hits in ``chunk`` can be found.

    A token holds no white space, so it hits inside one chunk.  There each of
    its runs of ASCII word characters is a whole run of the chunk, and a token
    without such a run is a whole symbol run.  So the keys are the runs of both sorts
    in windows of the chunk, each with its window; a chunk shorter than a window is the
    only one.  What comes out grows with the length of the chunk, not with its square.
    """
    folded = fold_ascii(chunk)

    def keyed(piece, context):
        keys = F.array_distinct(F.regexp_extract_all(piece, F.lit(_RUNS), F.lit(1)))
        return F.transform(keys, lambda k: F.struct(k.alias("key"), context.alias("context")))

    within = F.transform(_windows(folded), lambda w: keyed(w["piece"], w["context"]))
    return F.when(F.char_length(chunk) < _WIDTH, keyed(folded, folded)).otherwise(F.flatten(within))


def text_keys(text):
    """(key, chunk) of a text: its distinct word runs, under which plain tokens are found,
    and, with a NULL key, its distinct chunks that hold a symbol (see ``match_keys``).

    No run goes beyond white space, so those of the text are those of its chunks.
    """
    none = F.lit(None).cast("string")
    runs = F.array_distinct(F.split(text, f"[^{WORD_CHARACTERS}]+"))
    runs = F.filter(runs, lambda r: (r != "") & (F.char_length(r) <= MAX_TERM))
    # Nothing but ASCII is left to be lowered.
    runs = F.array_distinct(F.transform(runs, F.lower))
    marked = F.array_distinct(F.split(text, r"\s+"))
    marked = F.filter(marked, lambda c: c.rlike(f"[^{WORD_CHARACTERS}]"))
    return F.concat(
        F.transform(runs, lambda r: F.struct(r.alias("key"), none.alias("chunk"))),
        F.transform(marked, lambda c: F.struct(none.alias("key"), c.alias("chunk"))),
    )


def anchor(token):
    """The one key a token is looked up by: its longest word run, else itself."""
    runs = F.filter(F.split(token, "[^a-z0-9_]+"), lambda r: r != "")
    longest = F.array_sort(
        F.transform(runs, lambda r: F.struct((-F.length(r)).alias("n"), r.alias("r")))
    )
    return F.coalesce(F.try_element_at(longest, F.lit(1))["r"], token)


def token_pattern(token):
    """Pattern of a token with symbols in its (folded) chunk; NULL for a plain
    token, for which the key says it all.  ASCII word bounds are spelled out as
    ``\\b`` of current Java counts letters beyond ASCII."""
    quoted = F.concat(
        F.lit(r"\Q"), F.replace(token, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")
    )
    bound = F.lit(f"(?:{RUN_EDGE})")
    pattern = F.concat(bound, quoted, bound, F.lit("|^"), quoted, F.lit("$"))
    return F.when(token.rlike("[^a-z0-9_]"), pattern)


def routing_key_matches(key, pattern):
    """FLT-8: dotted pattern in which ``*`` is exactly one word."""
    words = [r"[^.]+" if w == "*" else _quoted(w) for w in pattern.split(".")]
    return key.rlike("^" + r"\.".join(words) + "$")


def _quoted(word):
    return r"\Q" + word + r"\E"
