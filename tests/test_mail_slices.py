"""Mail is parsed in slices, whatever the size of a batch."""

import pandas as pd

from tributary.operators import mail


def test_a_large_batch_is_parsed_in_slices():
    n = 2 * mail.SLICE + 3
    raw = [f"Subject: s{k}\n\nbody {k}".encode() for k in range(n)]
    batches = [pd.DataFrame({"mail_id": range(n), "data": raw}), pd.DataFrame({"mail_id": [], "data": []})]
    made = list(mail._parsed_batches(iter(batches)))
    assert [len(b) for b in made] == [mail.SLICE, mail.SLICE, 3]
    whole = pd.concat(made)
    assert list(whole.mail_id) == list(range(n)) and "data" not in whole
    assert list(whole.subject) == [f"s{k}" for k in range(n)]
    assert list(whole.content) == [f"body {k}" for k in range(n)]
