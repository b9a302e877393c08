"""Parts of a text that both byte-level and piece vocabularies encode apart from each other.

A byte-level pattern never joins a character with the white space before it, but for one
space, nor with the white space behind it; ``units`` cuts there. A piece vocabulary cuts at
the same places, as a space only begins a piece and most control characters stand alone, unless
spaces stand side by side, the text holds other white space or white space that the vocabulary
has in longer pieces, as a carriage return behind punctuation (``Pieces.joined``).
"""

from __future__ import annotations

import os
import re
from array import array

# White space by the character database, as the pattern's \s has it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# A word with the space before it; all white space but the last before a word; the last.
units = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]").findall
# White space that is not cut at in a piece vocabulary: spaces side by side, a piece's own mark, white space beyond ASCII.
JOINED = f"  |\u2581|[{WHITE[6:]}]"
joined = re.compile(JOINED).search


class ByteLevel:
    """A byte-level vocabulary and its tokens' bytes."""

    def __init__(self, path: str, plain: bool):
        """``plain``: the literals of special tokens in a text are ordinary text."""
        from tokenizers import Tokenizer

        # Spark runs one task for each core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.added = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def token_bytes(self) -> list[bytes]:
        """The bytes that every id stands for."""
        # Printable bytes stand for themselves, the others, in order, for characters from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        out = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            out[i] = bytes(byte[c] for c in token)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            out[i] = token.content.encode()
        return out


class Pieces:
    """A piece vocabulary and its pieces' bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        longer = set("".join(p for p in map(self.model.id_to_piece, range(self.model.get_piece_size())) if len(p) > 1))
        # Whether a text has white space that a piece may hold beside other characters.
        self.joined = re.compile("|".join([JOINED, *(c for c in WHITE[:5] if c in longer)])).search

    def ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in self.model.encode(texts, num_threads=1)]

    def unit_ids(self, parts: list[str]) -> list[bytes]:
        """Ids of units inside a text: behind a line feed, which stands alone, and without the two ids up to it."""
        return [array("I", ids[2:]).tobytes() for ids in self.model.encode(["\n" + p for p in parts], num_threads=1)]

    def token_bytes(self) -> list[bytes]:
        size = self.model.get_piece_size()
        return [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("\u2581", " ").encode()
            for i in range(size)
        ]
