"""Payload encoding and signature as column expressions."""

from pyspark.sql import functions as F

BLOCK_BYTES = 64

#: The pads of RFC 2104, eight bytes of each.
INNER_PAD, OUTER_PAD = 0x3636363636363636, 0x5C5C5C5C5C5C5C5C


def hmac_sha256(key, message):
    """FN-3: hex HMAC (RFC 2104) of two text columns.

    Spark has sha2 but no hmac.  The key block is padded as hex text and
    combined with the pads eight bytes at a time; the message is hashed as is.
    """
    raw = key.cast("binary")
    block = F.when(F.octet_length(raw) > BLOCK_BYTES, F.sha2(raw, 256)).otherwise(
        F.hex(raw)
    )
    block = F.rpad(block, 2 * BLOCK_BYTES, "0")
    inner = F.sha2(F.concat(_padded(block, INNER_PAD), message.cast("binary")), 256)
    return F.sha2(F.concat(_padded(block, OUTER_PAD), F.unhex(inner)), 256)


def _padded(block, pad):
    def word(at):
        signed = F.conv(F.substring(block, at, 16), 16, -10).cast("bigint")
        return F.lpad(F.hex(signed.bitwiseXOR(F.lit(pad))), 16, "0")

    return F.unhex(F.concat(*[word(at) for at in range(1, 2 * BLOCK_BYTES, 16)]))


def base64_text(text):
    """FN-4: base64 on one line, whatever the session says about chunking."""
    return F.regexp_replace(F.base64(text.cast("binary")), r"[\r\n]", "")


def form_encoded(**fields):
    """FN-5: ``name=value`` pairs joined by ``&``."""
    pairs = [
        F.concat(
            F.lit(name + "="),
            F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")),
        )
        for name, value in fields.items()
    ]
    return F.concat_ws("&", *pairs)
