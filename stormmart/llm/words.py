"""Words of whole texts as bytes, some at a time, and their counts per task."""

from __future__ import annotations

from collections.abc import Iterator

#: Bytes of one text whose words are split at once.
BLOCK_BYTES = 4_000_000
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 200_000


def word_table(inside: str) -> bytes:
    """A bytes.translate table: A-Z becomes a-z, bytes whose character (as Latin-1)
    is in ``inside`` stay, all others become spaces."""
    kept = set(inside.encode("latin-1"))
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in kept else 0x20 for b in range(256))


def word_blocks(text: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The words of a text; a long one is cut between words."""
    shown, at = text.translate(table), 0
    while at < len(shown):
        end = shown.find(b" ", at + BLOCK_BYTES)
        end = len(shown) if end < 0 else end
        yield shown[at:end].split()
        at = end
