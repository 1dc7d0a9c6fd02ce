"""Column expressions over web addresses."""

from pyspark.sql import functions as F

#: What counts as an image address, and the photo services.
IMAGE_PATTERN = r"(?i)\.(jpg|jpeg|png|gif)(?:[?#].*)?$"
YFROG, YFROG_SUFFIX = "yfrog.com", ":iphone"
TWITPIC, TWITPIC_PREFIX = "twitpic.com", "http://twitpic.com/show/large/"
PHOTO_BY_ID = ("plixi.com",)
PHOTO_BY_CLASS = ("instagr.am", "flic.kr")


def netloc(url):
    """FN-12: host and port as written; '' when the address names no host.

    ``parse_url`` is not used: it gives NULL for symbol domains and for
    addresses holding a blank or a bar, and it cuts the port.
    """
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def domain(url):
    """The lower-cased netloc that the list of short domains holds."""
    return F.lower(netloc(url))


def url_path(url):
    """FN-12: the path, without parameters, query and fragment."""
    rest = F.regexp_extract(
        url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1
    )
    return F.regexp_replace(rest, ";[^/]*$", "")


def basename(url):
    """FN-12: what follows the last slash of the path."""
    return F.element_at(F.split(url_path(url), "/"), -1)


def extension(url):
    """FN-12: last three characters of the file name, lower-cased."""
    return F.lower(F.right(basename(url), F.lit(3)))


def is_image(url):
    """FLT-11."""
    return url.rlike(IMAGE_PATTERN)


def photo_address(url):
    """FN-14: address of the picture on services that need no page; else NULL."""
    host = netloc(url)
    segment = F.try_element_at(F.split(url, "/"), F.lit(4))
    return F.when(host == YFROG, F.concat(F.trim(url), F.lit(YFROG_SUFFIX))).when(
        host == TWITPIC, F.concat(F.lit(TWITPIC_PREFIX), segment)
    )


def has_photo_page(url):
    """FN-15: is this a page that shows one photo?"""
    return netloc(url).isin(*PHOTO_BY_ID, *PHOTO_BY_CLASS)


def page_photo(url, html):
    """FN-15: source of the photo element of a captured page; else NULL."""
    host = netloc(url)
    return F.when(
        host.isin(*PHOTO_BY_ID), _source_of(_photo_tag(html, "id"))
    ).when(host.isin(*PHOTO_BY_CLASS), _source_of(_photo_tag(html, "class")))


def _photo_tag(html, attribute):
    return F.regexp_extract(
        html, rf"""(?i)<img\b[^>]*\b{attribute}\s*=\s*["']photo["'][^>]*>""", 0
    )


def _source_of(tag):
    found = F.regexp_extract(tag, r"""(?i)\bsrc\s*=\s*["']([^"']*)["']""", 1)
    return F.when(found != "", found)
