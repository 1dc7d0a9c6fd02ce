"""From captured mail to drops, attachments and comments."""

from tributary.operators import mail


def to_drops(mails, rivers, store_url="attachments/"):
    """(drops, attachment store, quarantine) of mail to rivers."""
    parsed = mail.parse(mail.with_rivers(mails, rivers))
    return (
        mail.to_drops(parsed, store_url),
        mail.attachment_store(mail.attachments(parsed)),
        mail.quarantined(parsed),
    )


def to_comments(mails, auth_tokens, api_url, api_key):
    """Comments to post for mail that answers a notification."""
    return mail.to_comments(
        mail.parse(mail.with_tokens(mails, auth_tokens)), api_url, api_key
    )
