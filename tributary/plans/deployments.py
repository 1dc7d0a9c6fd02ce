"""From push requests to signed payloads and the log of what was pushed."""

from tributary.operators import push


def outgoing(requests, kind):
    """Signed payloads of the requests for deployments of ``kind``."""
    return push.outbox(push.wanted(requests, kind))


def delivered(log, settings, pushed, as_of):
    """(push log, push settings) after the drops of ``pushed`` were accepted."""
    return (
        push.update_log(log, pushed, as_of),
        push.update_pending(settings, pushed),
    )
