"""Token counts and ids with public tokenizers.

Overlap resynchronisation: a huge text is encoded in overlapping chunks with offsets.  Two neighbouring chunks are
spliced at a boundary that both have and that is proven stable: a token of each starts at a white space character that
follows a character which is none.  Both pre-tokenizers at hand cut there whatever stands around it, so what is encoded
left and right of it is what the whole text gives.  Without such a boundary in the overlap the overlap is doubled, up to
the whole rest of the text.

Defined results: a null text has no tokens; ties, repeated rows and extra columns, whatever their names, change nothing
(each row gets its own result); an empty table gives an empty result; a very long text is encoded in chunks where its
tokenizer has the boundary, else whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from .common import prepare, slices, span_hashes

CHUNK_CHARS, OVERLAP_CHARS = 1 << 14, 1 << 8
STABLE = re.compile(r"(?<=\S)\s")
#: Characters on which the pre-tokenizer's pattern gives the same in any Unicode version.
UNUSUAL = re.compile("[^\\t\\n\\r\\x20-\\x7e¡-¬®-ɏ]")
#: The pattern that byte-level BPE splits by (fixed values of the vocabulary).
GPT2_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes by the library that a file's ending names."""

    def __init__(self, path: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.chunk, self.overlap, self.widened = chunk_chars, overlap_chars, 0
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            self.tok, self.piece = Tokenizer.from_file(path), None
            self.tok.no_padding()
            self.tok.no_truncation()
            with open(path) as f:
                spec = json.load(f)
            pre = spec.get("pre_tokenizer") or {}
            self.byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
            # only byte-level pre-tokenizers have the proven boundary; others, and sentencepiece, encode whole texts
            self.stable = self.byte_level and not any(re.search(r"\s", x["content"]) or x["lstrip"] or x["rstrip"] for x in spec.get("added_tokens") or [])
        else:
            import sentencepiece

            self.tok, self.piece, self.stable, self.byte_level = None, sentencepiece.SentencePieceProcessor(model_file=path), False, False

    def ids(self, texts: list[str]) -> list[list[int]]:
        if self.piece is not None:
            return self.piece.encode(texts, num_threads=1)
        return [x.ids for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def spliced(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, in pieces that together are those of the whole text."""
        if not self.stable or len(text) <= self.chunk:
            yield self.ids([text])[0]
            return
        start, skip, overlap = 0, 0, self.overlap  # skip: where in the text the next piece begins
        while True:
            stop = min(len(text), start + self.chunk + overlap)
            here = self.tok.encode(text[start:stop], add_special_tokens=False)
            begins = np.fromiter((a for a, _ in here.offsets), np.int64, len(here.offsets)) + start
            first = int(np.searchsorted(begins, skip))
            if stop == len(text):
                yield here.ids[first:]
                return
            # the next chunk starts an overlap before this one's end; both must have a token that starts at the boundary
            then_start = stop - overlap
            then_stop = min(len(text), stop + overlap)
            then = self.tok.encode(text[then_start:then_stop], add_special_tokens=False)
            common = set(begins.tolist()) & {a + then_start for a, _ in then.offsets}
            cut = next((m.start() for m in STABLE.finditer(text, then_start + 1, stop) if m.start() in common and m.start() > skip), None)
            if cut is None:
                if overlap >= len(text):
                    yield self.ids([text[skip:]])[0]
                    return
                overlap, self.widened = overlap * 2, self.widened + 1
                continue
            last = int(np.searchsorted(begins, cut))
            yield here.ids[first:last]
            # the next chunk begins at the cut, which is a stable boundary
            start, skip, overlap = cut, cut, self.overlap

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        short = [i for i, x in enumerate(texts) if len(x) <= self.chunk or not self.stable]
        for i, ids in zip(short, self.ids([texts[i] for i in short]), strict=True):
            out[i] = len(ids)
        for i in set(range(len(texts))) - set(short):
            out[i] = sum(map(len, self.spliced(texts[i])))
        return out


#: Classes of characters up to U+024F: white space, letter, number, other, the break between texts, and unusual ones.
SPACE, LETTER, NUMBER, OTHER, BREAK, ODD = range(6)


def _classes() -> np.ndarray:
    import unicodedata

    out = np.full(0x251, ODD, np.uint8)
    for c in range(0x250):
        if not UNUSUAL.match(chr(c)):
            kind = unicodedata.category(chr(c))[0]
            out[c] = SPACE if chr(c) in "\t\n\r " else LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    out[0] = BREAK
    return out


CLASSES = _classes()


def pre_tokens(chars: np.ndarray) -> np.ndarray:
    """Whether a pre-token of GPT2_PATTERN starts at each character.  chars: code points; texts stand between zeros."""
    kind = CLASSES[np.minimum(chars, 0x250)]
    before, after = np.r_[np.uint8(BREAK), kind[:-1]], np.r_[kind[1:], np.uint8(BREAK)]
    blank_before = np.r_[False, chars[:-1] == 0x20]
    space = kind == SPACE
    start = np.where(space, (before != SPACE) | ((after != SPACE) & (after != BREAK)), (kind != before) & ~blank_before)
    start |= kind == BREAK
    for i in np.flatnonzero((chars == 0x27) & start & (after == LETTER)).tolist():
        tail = "".join(map(chr, chars[i + 1 : i + 3].tolist()))
        n = 2 if tail[:1] in ("s", "t", "m", "d") else 3 if tail in ("re", "ve", "ll") else 0
        if n:
            start[i + 1 : i + n] = False
            if i + n < len(start):
                start[i + n] = True
    return start


class CachedByteBpe:
    """Ids of byte-level BPE, as 16-bit integers where the vocabulary allows.

    The library encodes each distinct pre-token once, as long as it is among the last `limit` ones; texts with unusual
    characters or with a special token's string are given to it whole.  A pre-token's ids don't depend on its neighbours,
    so the result is the library's own.
    """

    def __init__(self, path: str, limit: int = 2_000_000):
        self.encoder, self.limit = Encoder(path), limit
        self.special = [x.content for x in self.encoder.tok.get_added_tokens_decoder().values()]
        self.vocab = self.encoder.tok.get_vocab_size()
        self.kind = np.uint16 if self.vocab <= 1 << 16 else np.uint32
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.n = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat, self.used = np.empty(1 << 16, self.kind), 0

    def learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Adds sorted new keys, whose pre-tokens are words."""
        got, owner = [], []
        for a in range(0, len(words), 5000):
            e = self.encoder.tok.encode(words[a : a + 5000], is_pretokenized=True, add_special_tokens=False)
            got.append(np.array(e.ids, self.kind))
            owner.append(np.array(e.word_ids, np.int64) + a)
        ids, owner = np.concatenate(got), np.concatenate(owner)
        n = np.bincount(owner, minlength=len(words))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.r_[self.flat, np.empty_like(self.flat)]
        self.flat[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(n) - n
        self.used += len(ids)
        place = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.n = np.insert(self.keys, place, keys), np.insert(self.at, place, at), np.insert(self.n, place, n)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        if len(self.keys) > self.limit:
            self.clear()
        chars = np.frombuffer(("\0" + "\0".join(x.replace("\0", "\x01") for x in texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        breaks = np.flatnonzero(chars == 0)
        odd_at = np.flatnonzero(CLASSES[np.minimum(chars, 0x250)] == ODD)
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(breaks, odd_at) - 1] = True
        for s in self.special:
            for i, x in enumerate(texts):
                if s in x:
                    odd[i] = True
        if odd.any():
            return self._mixed(texts, odd)
        starts = np.flatnonzero(pre_tokens(chars))
        bytes_at = np.r_[0, np.cumsum(1 + (chars >= 0x80))]
        raw = ("\0" + "\0".join(texts) + "\0").encode()
        begin, end = bytes_at[starts], np.r_[bytes_at[starts[1:]], len(raw)]
        real = chars[starts] != 0
        begin, end, owner = begin[real], end[real], np.searchsorted(breaks, starts[real]) - 1
        keys, first, where = np.unique(span_hashes(raw, begin, end), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[place] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            self.learn(keys[new], [raw[a:b].decode() for a, b in zip(begin[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
        if not len(keys):
            return np.empty(0, self.kind), np.zeros(len(texts), np.int64)
        place = np.searchsorted(self.keys, keys)[where]
        n = self.n[place]
        ids = self.flat[np.repeat(self.at[place] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        return ids, np.bincount(owner, weights=n, minlength=len(texts)).astype(np.int64)

    def _mixed(self, texts: list[str], odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain = [i for i in range(len(texts)) if not odd[i]]
        ids, n = self.encode([texts[i] for i in plain]) if plain else (np.empty(0, self.kind), np.empty(0, np.int64))
        parts: dict[int, np.ndarray] = dict(zip(plain, np.split(ids, np.cumsum(n)[:-1]), strict=True)) if plain else {}
        whole = np.flatnonzero(odd).tolist()
        for i in whole:
            parts[i] = np.concatenate([np.array(p, self.kind) for p in self.encoder.spliced(texts[i])])
        return np.concatenate([parts[i] for i in range(len(texts))]), np.array([len(parts[i]) for i in range(len(texts))], np.int64)


class WholeTexts:
    """Ids as the library gives them, of tokenizers that aren't byte-level BPE."""

    kind = np.uint32

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.vocab = self.encoder.tok.get_vocab_size() if self.encoder.tok is not None else self.encoder.piece.vocab_size()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [np.array(x, self.kind) for x in self.encoder.ids(texts)]
        return np.concatenate([*got, np.empty(0, self.kind)]), np.array([len(x) for x in got], np.int64)


_HELD: dict[str, CachedByteBpe | WholeTexts] = {}


def held_encoder(path: str) -> CachedByteBpe | WholeTexts:
    """This worker process's encoder, kept from task to task with the pre-tokens that it has seen."""
    if path not in _HELD:
        _HELD[path] = CachedByteBpe(path) if Encoder(path).byte_level else WholeTexts(path)
    return _HELD[path]


def _counter(path: str, limit: int):
    def counts(encoder: Encoder, texts: list[str]) -> list[int]:
        if not encoder.byte_level:
            return encoder.counts(texts)
        short = [i for i, x in enumerate(texts) if len(x) <= encoder.chunk]
        out = dict(zip(short, held_encoder(path).encode([texts[i] for i in short])[1].tolist(), strict=True)) if short else {}
        return [out[i] if i in out else sum(map(len, encoder.spliced(x))) for i, x in enumerate(texts)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in slices(batches, "text", 4 << 20, 500):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            n = pa.array(counts(encoder, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x.encode()) for x in texts], pa.int64()), n, pa.compute.greater(n, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, UTF-8 bytes, tokens, and whether there are more than `limit` tokens, of each row's whole text."""
    prepare(docs.sparkSession)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return rows.mapInArrow(_counter(path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
