"""Token ids of whole texts by the tokenizers library, with a bounded store of encoded words.

A byte-level BPE splits a text before every space that follows a non-space, and
between a letter and the punctuation after it, so the ids of a text are the ids of
such parts one after another. Parts repeat a great deal: Arrow finds the distinct ones
of a batch and looks them up, the library encodes those that are new, and numpy lays
the ids out. Texts in which white space precedes a space are encoded whole by
the library.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
#: ASCII punctuation but the apostrophe and the underscore; the tokenizer splits between a letter and these.
CLOSING = "!\"#$%&()*+,-./:;<=>?@[\\]^`{|}~"
#: White space other than a space or a line feed.
_OTHER_SPACE = re.compile(r"[^\S \n]")


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of ``pool`` one after another, and their bounds in the result."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    kind = np.int32 if max(len(pool), ends[-1]) < 1 << 31 else np.int64
    at = np.repeat((starts - ends[:-1]).astype(kind), sizes)
    at += np.arange(ends[-1], dtype=kind)
    return pool[at], ends


def _strings(raw: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype("<i8")), pa.py_buffer(raw))


class Encoder:
    """Ids of texts as little-endian numpy arrays of ``dtype``, the narrowest that holds the vocabulary.

    For byte-level BPE files; ``whole_texts=True`` hands every text to the library as
    it is and fits any tokenizer. The string of an added token in a text is that token, as
    the library has it, so such texts are encoded whole. When more than ``store`` parts are kept, the half that was used longest ago goes.
    """

    def __init__(self, path: str, store: int = 600_000, whole_texts: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.store = store
        self.whole_texts = whole_texts
        self.parts = pa.array([], pa.large_string())
        self.pool = np.zeros(0, dtype=self.dtype)
        self.starts = self.sizes = self.used = np.zeros(0, dtype=np.int64)
        self.batches = 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def _has_added(self, text: str) -> bool:
        return self.added is not None and self.added.search(text) is not None

    def encode(self, texts: list) -> list[np.ndarray]:
        """Ids of each text; a null text is empty."""
        if len(self.parts) > self.store:
            self._forget()
        texts = [t or "" for t in texts]
        marked = [None if self.whole_texts or self._has_added(t) else _marked(t) for t in texts]
        units = pc.split_pattern(pa.array([m or "" for m in marked], pa.large_string()), " ")
        coded = units.flatten().dictionary_encode()
        table, ends = self._units(coded.dictionary)
        at = coded.indices.to_numpy()
        flat, bounds = _gathered(table, ends[:-1][at], np.diff(ends)[at])
        cuts = bounds[units.offsets.to_numpy() - units.offsets[0].as_py()]
        return [self.whole(t) if m is None else flat[cuts[i] : cuts[i + 1]] for i, (t, m) in enumerate(zip(texts, marked, strict=True))]

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units one after another, and their bounds: each unit's core, then its closing punctuation."""
        cores = pc.utf8_rtrim(units, characters=CLOSING)
        splits = pc.utf8_is_alnum(pc.utf8_slice_codeunits(cores, -1, stop=None)).to_numpy(zero_copy_only=False)
        cores = pc.if_else(pa.array(splits), cores, units)
        raw, offsets = _buffers(units)
        core_sizes = pc.binary_length(cores).to_numpy()
        # Closing punctuation stands for itself: a unit with a leading '\\x00'.
        tails, bounds = _gathered(raw, offsets[:-1] + core_sizes, np.diff(offsets) - core_sizes)
        tails = pc.binary_join_element_wise(pa.scalar("\x00", pa.large_string()), _strings(tails, bounds), pa.scalar("", pa.large_string()))
        parts = pa.concat_arrays([cores, tails]).dictionary_encode()
        starts, sizes = self._looked_up(parts.dictionary)
        at = parts.indices.to_numpy().reshape(2, -1).T.ravel()  # core and tail of each unit in turn
        flat, ends = _gathered(self.pool, starts[at], sizes[at])
        return flat, ends[::2]

    def _looked_up(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the pool has the ids of distinct parts; new ones are encoded first."""
        at = pc.fill_null(pc.index_in(parts, value_set=self.parts), -1).to_numpy().astype(np.int64)
        new = at < 0
        if new.any():
            fresh = parts.filter(pa.array(new))
            at[new] = len(self.parts) + np.arange(len(fresh))
            ids = self._encoded(fresh.to_pylist())
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // self.dtype.itemsize
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.used = np.concatenate([self.used, sizes])
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), dtype=self.dtype)])
            self.parts = pa.concat_arrays([self.parts, fresh])
        self.batches += 1
        self.used[at] = self.batches
        return self.starts[at], self.sizes[at]

    def _forget(self) -> None:
        kept = np.argsort(self.used, kind="stable")[len(self.used) - self.store // 2 :]
        self.parts, self.used = self.parts.take(pa.array(kept)), self.used[kept]
        self.pool, ends = _gathered(self.pool, self.starts[kept], self.sizes[kept])
        self.starts, self.sizes = ends[:-1], np.diff(ends)

    def _encoded(self, parts: list[str], at_once: int = 256) -> list[bytes]:
        """Ids of parts: ``at_once`` encoded as one text and cut at their starts; those at a text's ends alone.

        A part that starts with a line feed stands for itself, one with a leading
        '\\x00' for the rest, any other follows a space.
        """
        out: list[bytes] = [b""] * len(parts)
        inner = []
        for i, p in enumerate(parts):
            if p[:1] in ("", "\x00"):
                out[i] = self.whole(p[1:]).tobytes()
            elif p[-1].isspace():
                out[i] = self.whole(p if p[0] == "\n" else " " + p).tobytes()
            else:
                inner.append(i)
        for a in range(0, len(inner), at_once):
            some = inner[a : a + at_once]
            led = [parts[i] if parts[i][0] == "\n" else " " + parts[i] for i in some]
            got = self.tokenizer.encode("".join(led), add_special_tokens=False)
            lengths = np.fromiter(map(len, led), dtype=np.int64, count=len(led))
            first = np.array([o[0] for o in got.offsets], dtype=np.int64)
            cuts = np.append(np.searchsorted(first, np.cumsum(lengths) - lengths, "left"), len(first))
            raw = np.array(got.ids, dtype=self.dtype).tobytes()
            cuts = (cuts * self.dtype.itemsize).tolist()
            for i, b, e in zip(some, cuts[:-1], cuts[1:], strict=True):
                out[i] = raw[b:e]
        return out


def _buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and bounds of an array without nulls."""
    _, offsets, data = strings.buffers()
    bounds = np.frombuffer(offsets, "<i8")[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


def _marked(text: str) -> str | None:
    """The text with '\\x00' before it and a space before each line feed that starts a unit as a space does.

    None if units that follow a space could belong together. Line feeds are marked if
    all stand between two non-spaces.
    """
    if "  " in text or " \n" in text or "\n " in text or text.endswith(" ") or "\x00" in text:
        return None
    if _OTHER_SPACE.search(text):
        return None if re.search(r"\s ", text) else "\x00" + text
    if "\n\n" in text or text[:1] == "\n" or text[-1:] == "\n":
        return "\x00" + text
    return "\x00" + text.replace("\n", " \n")


@functools.cache
def shared_encoder(path: str) -> Encoder:
    """The encoder of this process, so that what one task has learned serves the next."""
    return Encoder(path)
