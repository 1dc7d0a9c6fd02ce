"""The two enrichers of a drop: links and images; tags and places."""

from tributary.operators import entities, media
from tributary.sources import staging


def links_and_images(
    drops, expanded, probes, photos=None, merge_links=False, id_column="id"
):
    """Drops with ``links`` and ``media``.

    ``expanded`` comes from ``media.expansions``.  Text is searched once;
    its addresses are stored, and only (id, pos, address) is shuffled until the
    short lists are joined back to the drops.
    """
    # A drop that is there several times, once per part of its targets or in two
    # feeds, mentions its addresses once.
    mentions = media.extract_urls(drops, id_column).distinct()
    found = staging.written(mentions, "addresses")
    facts = staging.written(
        media.url_facts(found, expanded, probes, photos), "address-facts"
    )
    lists = media.collect(media.resolve(found, facts))
    return media.attach(drops, lists, merge_links, id_column)


def tags_and_places(drops, attempts, max_retries=entities.MAX_RETRIES):
    """Drops with ``tags`` and ``places`` from the captured answers."""
    return entities.attach(drops, entities.accept(attempts, max_retries))
