"""Single-byte encodings told apart by the likelihood of a file's upper bytes."""

from __future__ import annotations

import math
import unicodedata
from functools import reduce

from pyspark.sql import Column, functions as F

#: Candidates in order of preference where likelihoods tie.
SINGLE_BYTE = {"windows-1250": "cp1250", "latin-1": "latin-1", "cp1252": "cp1252"}
# The letters beyond ASCII that are common in the languages each code page was made for.
_CENTRAL = "ąćęłńóśźżáčďéěíňřšťúůýžöőüűăâîşţđäôľĺŕç"
_WESTERN = "àâäáãåæçéèêëíìîïñóòôöõøúùûüßœÿý"
#: Shares of the characters that an encoding is expected to give: common letters, their capitals, typographic signs, other
#: signs and letters; what is left over is spread over control characters and bytes without a meaning.
LETTERS, CAPITALS, SIGNS, OTHERS, NEVER = 0.75, 0.1, 0.1, 0.05, 1e-7
_TYPOGRAPHIC = "“”‘’„‚–—…•€™«»"


def _shares(encoding: str) -> dict[int, float]:
    """Probability of every upper byte under an encoding."""
    common = _CENTRAL if encoding == "cp1250" else _WESTERN
    kinds: dict[int, str] = {}
    for byte in range(0x80, 0x100):
        try:
            sign = bytes([byte]).decode(encoding)
        except UnicodeDecodeError:
            kinds[byte] = "never"
            continue
        if unicodedata.category(sign) == "Cc":
            kinds[byte] = "never"
        elif sign in common:
            kinds[byte] = "letter"
        elif sign.lower() in common:
            kinds[byte] = "capital"
        else:
            kinds[byte] = "sign" if sign in _TYPOGRAPHIC else "other"
    whole = {"letter": LETTERS, "capital": CAPITALS, "sign": SIGNS, "other": OTHERS}
    sizes = {kind: sum(k == kind for k in kinds.values()) for kind in whole}
    return {byte: NEVER if kind == "never" else whole[kind] / sizes[kind] for byte, kind in kinds.items()}


#: log2 likelihood of each upper byte, by encoding, in units of 1/1000 bit: whole numbers add up alike in any order.
WEIGHTS = {name: {b: round(1000 * math.log2(p)) for b, p in _shares(codec).items()} for name, codec in SINGLE_BYTE.items()}


def upper_bytes(value: Column) -> Column:
    """Code points of a raw line's bytes from 0x80 on, one entry per byte."""
    kept = F.regexp_replace(F.decode(value, "ISO-8859-1"), "[\x00-\x7f]+", "")
    return F.transform(F.filter(F.split(kept, ""), lambda c: c != ""), F.ascii)


def likelihood(byte: Column, encoding: str) -> Column:
    """Weight of one byte under an encoding."""
    weights = F.array(*[F.lit(WEIGHTS[encoding][b]) for b in range(0x80, 0x100)])
    return F.element_at(weights, byte - 0x7F)


def most_likely(totals: dict[str, Column]) -> Column:
    """Name of the encoding with the largest total; the first in order of preference if several share it."""
    best = F.greatest(*totals.values())
    return reduce(lambda rest, name: F.when(totals[name] == best, name).otherwise(rest), reversed(list(totals)), F.lit(None).cast("string"))


def decode_single_byte(value: Column, encoding: Column) -> Column:
    """Text of raw bytes. Bytes are read one to one; the code pages then only need their upper half mapped.

    A byte without a meaning in its code page becomes U+FFFD. This needs no session-wide switch for further character sets.
    """
    text = F.decode(value, "ISO-8859-1")
    upper = bytes(range(0x80, 0x100))
    for name, codec in SINGLE_BYTE.items():
        pairs = [(a, b) for a, b in zip(upper.decode("latin-1"), upper.decode(codec, "replace")) if a != b]
        if pairs:
            before, after = "".join(a for a, _ in pairs), "".join(b for _, b in pairs)
            text = F.when(encoding == name, F.translate(F.decode(value, "ISO-8859-1"), before, after)).otherwise(text)
    return text
