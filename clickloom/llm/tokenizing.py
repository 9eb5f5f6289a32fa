"""Token ids of texts by a public tokenizer file, with a bounded memory of words.

A byte-level tokenizer that splits at white space encodes " word" alike wherever
it stands, so the ids of words met before are put together and only new words
go through the library. Texts where that does not hold (white space other than
single blanks and line ends between words, special tokens) go through it whole.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

END_ID = 2
MOST_WORDS = 1_000_000  # kept words, some 200 MB; then the memory starts anew
GROUP_CHARS = 1 << 21
JOINED_WORDS = 20
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]

def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Texts to little-endian 32-bit ids, as ``Tokenizer.encode`` gives them."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallel part
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # A text with any of these has words that are not simply set apart.
        self.odd = (
            *OTHER_SPACES, "  ", " \n", "\n ", "\n\n",
            *(t["content"] for t in spec.get("added_tokens") or []),
        )
        splitter = spec.get("pre_tokenizer") or {}
        line_end = self._ids("\n")
        # Ids that begin with a blank (Ġ in a byte-level vocabulary), and the line end.
        signs = self.library.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(signs.values(), default=0) + 1, bool)
        self.opens[[i for sign, i in signs.items() if sign[:1] == "Ġ"] + line_end] = True
        self.by_word = (
            spec.get("normalizer") is None
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space")
            and len(line_end) == 1
            and "Ġ" in signs
        )
        # Marks that are one id after any letter.
        marks = {mark: self._ids(mark) for mark in ".,"}
        self.tails = {mark: ids[0] for mark, ids in marks.items() if len(ids) == 1}
        self._forget()

    def _forget(self) -> None:
        """Start the memory anew: word ``i`` has the ids ``flat[starts[i] : starts[i + 1]]``."""
        self.known: dict[str, int] = {}
        self.starts = np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, "<u4")

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, used = len(self.known), int(self.starts[len(self.known)])
        if n + len(words) >= len(self.starts):
            self.starts = np.resize(self.starts, 2 * (n + len(words)))
        if used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (used + len(ids)))
        self.flat[used : used + len(ids)] = ids
        self.starts[n + 1 : n + 1 + len(words)] = used + sizes.cumsum()
        self.known.update(zip(words, range(n, n + len(words)), strict=True))

    def _gather(self, rows: np.ndarray, more: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known words one after another, each with ``more`` places after it; sizes."""
        starts = self.starts[rows]
        sizes = self.starts[rows + 1] - starts + more
        ends = sizes.cumsum()
        at = np.arange(int(sizes.sum())) + np.repeat(starts - ends + sizes, sizes)
        return self.flat[np.minimum(at, len(self.flat) - 1)], sizes

    def _plain(self, text: str) -> bool:
        """Whether single blanks and line ends between words are all the text's white space."""
        return bool(text) and not (
            text[0] in " \n" or text[-1] in " \n" or any(mark in text for mark in self.odd)
        )

    def _ids(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _whole(self, text: str) -> bytes:
        return np.array(self._ids(text), "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        """Encode ``new``: "\nword" at the start of a line, else "word" after a blank."""
        marked = [p for p in new if p[-1:] in self.tails and p[-2:-1].isalpha() and p[-2] < "ɐ"]
        plain = set(new).difference(marked)
        plain.update([p[:-1] for p in marked])
        plain = [p for p in plain if p not in self.known]
        flat: list[int] = []
        for at in range(0, len(plain), JOINED_WORDS):
            some = plain[at : at + JOINED_WORDS]
            flat += self._ids("".join([p if p[0] == "\n" else f" {p}" for p in some]))
        ids = np.array(flat, "<u4")
        starts = np.flatnonzero(self.opens[ids])
        self._keep(plain, ids, np.diff(starts, append=len(ids)))
        if marked:
            rows = np.array([self.known[p[:-1]] for p in marked])
            ids, sizes = self._gather(rows, 1)
            ids[sizes.cumsum() - 1] = [self.tails[p[-1]] for p in marked]
            self._keep(marked, ids, sizes)

    def _group(self, texts: list[str]) -> list[bytes]:
        plain = list(map(self._plain, texts))
        lines = [
            f"\n{text}".replace("\n", " \n")[1:] for text, whole in zip(texts, plain) if whole
        ]
        if lines:
            words = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
            each = words.flatten().dictionary_encode()
            different = each.dictionary.to_numpy(zero_copy_only=False).tolist()
            rows = list(map(self.known.get, different))
            new = [w for w, row in zip(different, rows, strict=True) if row is None]
            if len(self.known) + len(new) > MOST_WORDS:
                self._forget()
                new = different
            if new:
                self._learn(new)
                rows = list(map(self.known.get, different))
            rows = np.array(rows, np.int64)
            ids, sizes = self._gather(rows[each.indices.to_numpy()])
            data = memoryview(ids.view(np.uint8))
            ends = np.concatenate([[0], sizes.cumsum()])[words.offsets.to_numpy()] * 4
            edges = iter(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
        out = []
        for text, whole in zip(texts, plain, strict=True):
            if whole:
                a, b = next(edges)
                out.append(bytes(data[a + 4 : b]))
            else:
                out.append(self._whole(text))
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text without an end id; null as an empty text."""
        if not self.by_word:
            return [self._whole(text or "") for text in texts]
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= GROUP_CHARS:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path)
