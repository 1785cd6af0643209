"""Word-wise use of a ``tokenizers`` vocabulary that drops white space.

The vocabulary's pre-tokenizer removes white space and no token spans it, so the ids of
a text are the ids of its words in a row. Each distinct word is encoded by the library
once per task and remembered, within a bound.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
import unicodedata
from itertools import chain

#: Bytes of keys that a table remembers in one of its two generations: some 20 bytes of
#: memory each. Whole words take two fifths of it on top.
KEY_BYTES = 5_000_000
#: Longer words are not remembered.
MEMORY_WORD = 64


def load(path: str | None):
    """The library's tokenizer for ``path`` (default: the public word-level BPE file)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    return Tokenizer.from_file(path)


def per_process(make, path: str | None, key_bytes: int = KEY_BYTES):
    """``make(tokenizer, key_bytes)``, kept for the later tasks of a worker process."""
    kept = sys.modules.setdefault("seedwise_worker_state", types.ModuleType("seedwise_worker_state"))
    key = f"{make.__name__}:{path}:{key_bytes}"
    if key not in kept.__dict__:
        kept.__dict__[key] = make(load(path), key_bytes)
    return kept.__dict__[key]


class Library:
    """The library's ids of many short pieces, by the shortest of its ways that is right.

    Pieces of ASCII letters go straight to its BPE model: normalising and cutting leave
    them as they are. Other pieces of letters are joined by spaces in one call: each is one
    word, whose last token alone has the word-end mark, which is where the ids are cut.
    Where the marks do not add up (a letter that is normalised to something else), and for
    all other pieces, each is encoded on its own.
    """

    CHUNK = 1000

    def __init__(self, tokenizer):
        import json

        import numpy as np
        self.tokenizer = tokenizer
        self.model = tokenizer.model
        vocab = json.loads(tokenizer.to_str())["model"]["vocab"]
        self.closes = np.zeros(tokenizer.get_vocab_size() + 1, dtype=bool)
        self.closes[[i for t, i in vocab.items() if t.endswith(RunCounter.END)]] = True

    def encode(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """piece -> ids as little-endian unsigned 32-bit bytes."""
        tokenize, pack = self.model.tokenize, struct.pack
        out: dict[bytes, bytes] = {}
        rest = []
        for p in pieces:
            if p.isalpha() and p.islower():
                t = tokenize(p.decode())
                out[p] = pack(f"<{len(t)}I", *[x.id for x in t])
            else:
                rest.append(p)
        for own, ids, ends in self._chunks(rest):
            raw, start = ids.tobytes(), 0
            for i, end in zip(own, (4 * ends).tolist()):
                out[rest[i]] = raw[start:end]
                start = end
        return out

    def count(self, pieces: list[bytes]) -> list[int]:
        """Number of ids of each piece."""
        import numpy as np
        tokenize = self.model.tokenize
        out = [len(tokenize(p.decode())) if p.isalpha() and p.islower() else 0 for p in pieces]
        rest = [i for i, n in enumerate(out) if not n]
        for own, _, ends in self._chunks([pieces[i] for i in rest]):
            for i, n in zip(own, np.diff(ends, prepend=0).tolist()):
                out[rest[i]] = n
        return out

    def _chunks(self, pieces: list[bytes]):
        """(places of pieces, their ids in a row, where each one's ids end)."""
        import numpy as np
        texts = [p.decode("utf-8", "replace") for p in pieces]
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        single = [i for i, t in enumerate(texts) if not t.isalpha()]
        chunks = [plain[i:i + self.CHUNK] for i in range(0, len(plain), self.CHUNK)]
        for chunk, e in zip(chunks, self._batch([" ".join([texts[i] for i in c]) for c in chunks])):
            ids = np.array(e.ids, dtype="<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(chunk):
                yield chunk, ids, ends
            else:
                single += chunk
        if single:
            encoded = self._batch([texts[i] for i in single])
            ids = np.array([i for e in encoded for i in e.ids], dtype="<u4")
            yield single, ids, np.cumsum([len(e) for e in encoded])

    def _batch(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []


def groups(raws: list[bytes], most: int = 1 << 19):
    """Ranges of texts of about ``most`` bytes, looked up together."""
    lo = size = 0
    for i, raw in enumerate(raws):
        size += len(raw)
        if size > most:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(raws):
        yield lo, len(raws)


class WordIds:
    """word -> its ids as little-endian unsigned 32-bit bytes.

    A word met for the first time is cut before its closing signs (a letter and a sign
    never share a token), so that "word," needs no second encoding of "word". The table
    keeps the words of its two last generations, so its memory is bounded.
    """

    def __init__(self, tokenizer, key_bytes: int = KEY_BYTES):
        self.library = Library(tokenizer)
        self.words = _Generations(key_bytes * 7 // 5)

    def of_texts(self, raws: list[bytes]) -> list[bytes]:
        split = [raw.split() if b"<|" in raw else raw.lower().split() for raw in raws]
        ids = self._find(dict.fromkeys(chain.from_iterable(split)))
        return [b"".join(map(ids.__getitem__, parts)) for parts in split]

    def _find(self, distinct) -> dict[bytes, bytes]:
        ids, missing = self.words.find(distinct)
        if not missing:
            return ids
        cuts = {w: c for w in missing if w[-1] in _SIGNS and len(c := _cut(w)) > 1}
        parts, fresh = self.words.find(dict.fromkeys(
            [p for c in cuts.values() for p in c] + [w for w in missing if w not in cuts]))
        made = self.library.encode(fresh)
        parts.update(made)
        self.words.keep(made)
        whole = {w: parts[stem] + parts[signs] for w, (stem, signs) in cuts.items()}
        self.words.keep(whole)
        ids.update(parts)
        ids.update(whole)
        return ids


_SIGNS = b".,!?;:|"


def _cut(word: bytes) -> list[bytes]:
    """The word before its closing signs, and these; no token spans a letter and a sign."""
    stem = word.rstrip(_SIGNS)
    if stem == word or not stem:
        return [word]
    end = stem[-1:]
    if end.isalpha() or end >= b"\x80" and _kind(_plain(stem.decode("utf-8", "replace")[-1])[-1]) == "L":
        return [stem, word[len(stem):]]
    return [word]


class _Generations:
    """A bounded table: when the young generation is full it becomes the old one, and what
    is asked for again moves back."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict = {}
        self.old: dict = {}
        self.size = 0

    def find(self, keys) -> tuple[dict, list[bytes]]:
        young, old = self.young, self.old
        found, back, missing = {}, {}, []
        for k in keys:
            v = young.get(k)
            if v is None:
                v = old.get(k)
                if v is None:
                    missing.append(k)
                    continue
                back[k] = v
            found[k] = v
        if back:
            self.keep(back)
        return found, missing

    def keep(self, new: dict) -> None:
        if any(len(k) > MEMORY_WORD for k in new):
            new = {k: v for k, v in new.items() if len(k) <= MEMORY_WORD}
        self.young.update(new)
        self.size += sum(map(len, new))
        if self.size > self.most:
            self.old, self.young, self.size = self.young, {}, 0


class PrefixSteps:
    """word -> how the token count changes with each further code point (16-bit steps).

    ``count(text[:i])`` is the count at the start of the word that holds position i plus
    the count of that word's prefix, so the steps of a text are the steps of its words,
    with 0 for white space. Word prefixes share a table: each distinct prefix is counted
    once. Runs of more than MEMORY_WORD letters or signs use :class:`RunCounter`.
    """

    def __init__(self, tokenizer, key_bytes: int = KEY_BYTES):
        self.tokenizer = tokenizer
        self.library = Library(tokenizer)
        self.runs: RunCounter | None = None
        self.words = _Generations(key_bytes * 2 // 5)
        self.prefixes = _Generations(key_bytes)

    def of_texts(self, raws: list[bytes]) -> list[bytes]:
        """Per text, one signed little-endian 16-bit step per code point."""
        import numpy as np
        split = [(raw if b"<|" in raw else raw.lower()).translate(_SPACES).split(b" ")
                 for raw in raws]
        counts, long = self._find(dict.fromkeys(chain.from_iterable(split)))
        out = []
        for parts in split:
            if long and not long.keys().isdisjoint(parts):
                out.append(b"\0\0".join([long[w] if w in long else _steps(counts[w])
                                         for w in parts]))
                continue
            # counts within the word, 0 for white space: a step is the difference
            own = np.frombuffer(b"\0".join(map(counts.__getitem__, parts)), dtype=np.uint8)
            steps = np.diff(own.astype("<i2"), prepend=np.int16(0))
            steps[own == 0] = 0
            out.append(steps.astype("<i2").tobytes())
        return out

    def _find(self, distinct) -> tuple[dict[bytes, bytes], dict[bytes, bytes]]:
        """word -> the counts of its prefixes, one byte each; and for words above
        MEMORY_WORD bytes -> their steps."""
        counts, missing = self.words.find(distinct)
        if not missing:
            return counts, {}
        long = {w: b"" for w in missing if len(w) > MEMORY_WORD}
        pieces = {w: _cut(w) if w not in long else
                  [r.encode("utf-8") for r in safe_runs(w.decode("utf-8", "replace"))]
                  for w in missing}
        found = self._prefixes({p for c in pieces.values() for p in c if len(p) <= MEMORY_WORD})
        whole = {}
        for w, cut in pieces.items():
            if w in long:
                long[w] = b"".join([_steps(found[p]) if p in found else self._run(p) for p in cut])
            elif len(cut) == 1:
                whole[w] = found[w]
            else:
                stem, signs = found[cut[0]], found[cut[1]]
                whole[w] = stem + bytes([stem[-1] + n for n in signs])
        self.words.keep(whole)
        counts.update(whole)
        return counts, long

    def _prefixes(self, pieces: set[bytes]) -> dict[bytes, bytes]:
        """piece -> the counts of its prefixes, one byte each. Each piece is cut back to its
        longest known prefix; the counts of the prefixes between come from the library, once
        each."""
        young, old = self.prefixes.young, self.prefixes.old
        back: dict[bytes, bytes] = {b"": b""}
        fresh: dict[bytes, bytes] = {}
        order: list[bytes] = []
        ways = []
        for p in pieces:
            q, start = p, len(order)
            while q not in fresh and q not in back:
                known = young.get(q) or old.get(q)
                if known is not None:
                    back[q] = known
                    break
                fresh[q] = b""
                order.append(q)
                q = q[:-1] if q[-1] < 0x80 else _shorter(q)
            if len(order) > start:
                ways.append((start, len(order), q))
        count = self.library.count(order)
        for start, end, q in ways:
            counts = fresh.get(q) or back[q]
            for i in range(end - 1, start - 1, -1):
                counts += _BYTE[count[i]]
                fresh[order[i]] = counts
        out = {p: fresh.get(p) or back[p] for p in pieces}
        self.prefixes.keep(fresh)
        self.prefixes.keep({q: v for q, v in back.items() if q and q not in young})
        return out

    def _run(self, piece: bytes) -> bytes:
        self.runs = self.runs or RunCounter(self.tokenizer)
        many = self.runs.counts(piece.decode("utf-8", "replace"))
        steps = list(map(int.__sub__, many[1:], many[:-1]))
        return struct.pack(f"<{len(steps)}h", *steps)


_BYTE = [bytes([n]) for n in range(256)]       # a piece has at most MEMORY_WORD tokens


def _steps(counts: bytes) -> bytes:
    """16-bit steps from prefix counts."""
    return struct.pack(f"<{len(counts)}h", *map(int.__sub__, counts, b"\0" + counts[:-1]))


_SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def _shorter(word: bytes) -> bytes:
    """Without the last code point."""
    end = len(word) - 1
    while end > 0 and word[end] & 0xC0 == 0x80:
        end -= 1
    return word[:end]


def _kind(ch: str) -> str:
    cat = unicodedata.category(ch)
    return "L" if cat[0] == "L" else "N" if cat[0] == "N" else "S"


def _plain(ch: str) -> str:
    """A character as the vocabulary's normaliser leaves it: composed, then in lower case,
    which may be several characters (a dotted capital I ends in a combining mark)."""
    return unicodedata.normalize("NFC", ch).lower()


def safe_runs(word: str) -> list[str]:
    """Cut a long word where no token, composition or special string can span the cut:
    beside a digit, or between a letter and a sign other than an apostrophe, and never
    beside a character whose normal form begins or ends with a mark at the cut."""
    if "<|" in word or not unicodedata.is_normalized("NFC", word) or re.search(r"\s", word):
        return [word]
    out, start = [], 0
    edges = [(p[0], p[-1]) for p in map(_plain, word)]
    kinds = [(_kind(a), _kind(b)) for a, b in edges]
    marks = [unicodedata.category(a)[0] == "M" or unicodedata.category(b)[0] == "M"
             for a, b in edges]
    for i in range(1, len(word)):
        a, b = kinds[i - 1][1], kinds[i][0]
        if "'" in (word[i - 1], word[i]) or marks[i - 1] or marks[i]:
            continue
        if a != b or a == "N":
            out.append(word[start:i])
            start = i
    out.append(word[start:])
    return out


class RunCounter:
    """Token counts of all prefixes of one long run by dynamic programming.

    With ranked merges, the tokens of a prefix end in exactly one token t for which the
    tokens of what precedes t may stand before t. So ``last[i]`` (the last token of the
    first i bytes) follows from earlier entries: try the tokens that end at i, keep the
    one that may follow ``last[i - len(t)]``. A prefix that ends the word ends in a token
    with the word-end mark, found the same way. Cost: run length x longest token.
    """

    END = "</w>"

    def __init__(self, tokenizer):
        import json
        model = json.loads(tokenizer.to_str())["model"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" "))
                  for m in model["merges"]]
        self.tokenizer = tokenizer
        self.rank = {m: i for i, m in enumerate(merges)}
        self.made_of = {}
        for a, b in merges:
            self.made_of.setdefault(a + b, (a, b))
        self.level = {a + b: self.rank[a, b] for a, b in reversed(merges)}
        self.vocab = set(model["vocab"])
        self.longest = max(len(t.removesuffix(self.END)) for t in self.vocab)
        self.fits: dict[tuple[str, str], bool] = {}

    def may_follow(self, a: str, b: str) -> bool:
        """Whether encoding the bytes of a and b together gives back a, b."""
        key = (a, b)
        if key not in self.fits:
            if len(self.fits) > 500_000:
                self.fits.clear()
            self.fits[key] = self._encode(self._symbols(a) + self._symbols(b)) == [a, b]
        return self.fits[key]

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.END):
            body = token.removesuffix(self.END)
            return [*body[:-1], body[-1] + self.END]
        return list(token)

    def _encode(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:]),
                       key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def counts(self, run: str) -> list[int]:
        """Counts of the prefixes of ``run``, from the empty one to the whole."""
        plain = self.tokenizer.normalizer.normalize_str
        chars = [plain(c) for c in run]
        one = self.tokenizer.pre_tokenizer.pre_tokenize_str("".join(chars))
        if plain(run) != "".join(chars) or len(one) != 1 or "<|" in run:
            # letters that compose, or several pieces: count each prefix by the library
            return [len(self.tokenizer.encode(run[:i], add_special_tokens=False))
                    for i in range(len(run) + 1)]
        text = one[0][0]                      # one character for each byte
        ends, at = [], 0
        for c in chars:
            at += len(c.encode())
            ends.append(at)
        last: list[str | None] = [None] * (len(text) + 1)
        many = [0] * (len(text) + 1)
        for i in range(1, len(text) + 1):
            for j in range(max(0, i - self.longest), i):
                t = text[j:i]
                if t in self.vocab and (j == 0 and self._whole(t) or
                                        j > 0 and last[j] and self.may_follow(last[j], t)):
                    last[i], many[i] = t, many[j] + 1
                    break
        out = [0]
        for i in ends:
            for j in range(max(0, i - self.longest), i):
                t = text[j:i] + self.END
                if t in self.vocab and (j == 0 and self._whole(t) or
                                        j > 0 and last[j] and self.may_follow(last[j], t)):
                    out.append(many[j] + 1)
                    break
            else:
                raise ValueError("no token ends this prefix")
        return out

    def _whole(self, token: str) -> bool:
        key = ("", token)
        if key not in self.fits:
            self.fits[key] = self._encode(self._symbols(token)) == [token]
        return self.fits[key]
