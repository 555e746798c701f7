"""Words of a text in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

# White space as the word contracts have it (space, ASCII 9 to 13), and A-Z in lower case.
LOWER = bytes(32 if b in (9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in range(256))
# Everything but digits, letters and bytes from 128 on parts words.
LETTERS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def word_blocks(text: str | None, table: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of the text's UTF-8 translated by `table`, whose only separator
    is the space, in lists of about `size` bytes."""
    data, at = (text or "").encode().translate(table), 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end
