"""Token ids of whole texts, as packers take them."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame

from prefdata.llm.common import map_batches, text_bytes

END = 0  # the id after each document
CACHE_WORDS = 400_000  # in each of two generations
CACHE_PARTS = 100_000
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Words that need no Unicode rules: ASCII without apostrophes (contractions) and angle
# brackets (special tokens), and the letters of Latin-1, which have no combining marks.
_PLAIN = re.compile(r"[!-&(-;=?-~À-ÖØ-öø-ÿ]+")
# How the tokenizer divides such a word in lower case: letters, single digits, the rest.
_DIVIDE = re.compile(r"[a-zà-öø-ÿß]+|[0-9]|[^a-zà-öø-ÿß0-9]+")


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for a byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Recent(dict):
    """Cache of two generations: what was used lately stays when it is full."""

    def __init__(self, size: int):
        super().__init__()
        self.size, self.old = size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = self.copy()
            self.clear()
        self[key] = value
        return value


class _PartTokens(_Recent):
    """Ids of letters or signs that the tokenizer takes as one word."""

    def __init__(self, tokenizer):
        super().__init__(CACHE_PARTS)
        self.model, self.letters = tokenizer.model, _byte_letters()

    def make(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(part)]).tobytes()


class WordTokens(_Recent):
    """Ids of a word (bytes without ASCII white space), remembered as uint32.

    The tokenizer drops white space and never joins what it divides, so a text's
    ids are its words' ids in turn. A plain word goes to the vocabulary part by part; any
    other goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__(CACHE_WORDS)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        known = os.path.basename(path) == TOKENIZER  # the rules above are this file's
        self.parts = _PartTokens(self.tokenizer) if known else None

    def make(self, word: bytes) -> bytes:
        text = word.decode()
        if self.parts is not None and _PLAIN.fullmatch(text):
            return b"".join(map(self.parts.__getitem__, _DIVIDE.findall(text.lower())))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def of(self, text: bytes) -> bytes:
        """Ids of the text and the end id."""
        return b"".join(map(self.__getitem__, text.split())) + array("I", [END]).tobytes()


def pieces(ids: bytes, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """(piece, start, ids) of at most ``capacity`` ids each; only the last may be shorter."""
    step = 4 * capacity
    for piece, at in enumerate(range(0, len(ids), step)):
        yield piece, at // 4, ids[at : at + step]


def token_pieces(
    docs: DataFrame, capacity: int, path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every document cut into pieces."""
    path = path or tokenizer_path()
    rows_at_once = 20_000

    def run(batches):
        words = WordTokens(path)
        names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
        rows: list[tuple] = []

        def columns():
            found = dict(zip(names, zip(*rows)))
            rows.clear()
            return found

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for piece, start, ids in pieces(words.of(text), capacity):
                    rows.append(
                        (doc_id, piece, start, len(ids) // 4, zlib.crc32(ids), ids if with_ids else None)
                    )
                if len(rows) >= (1_000 if with_ids else rows_at_once):
                    yield columns()
        if rows:
            yield columns()

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_batches(
        docs.select("doc_id", text_bytes().alias("text")),
        run,
        kinds + (", ids binary" if with_ids else ""),
    )
