"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

The vocabulary file (``tokenizers`` JSON: byte-level BPE, no normaliser) is a parameter. Results are
those of ``encode(text, add_special_tokens=False)`` and ``decode(ids, skip_special_tokens=False)``.

*Encoding one piece.* A sequence of tokens is the encoding of its bytes exactly if each two
neighbours are the encoding of their own bytes, so an encoding is found from left to right: take
the longest token that is compatible with the one before, step back where none is.

*Lookahead.* Whether a merge applies at a place depends on bytes up to its *reach*: its own length,
the reach of the merges that built its two parts, and that of earlier merges which compete for
either part. ``sufficient_lookahead`` is the largest reach of the merge list. A token that ends at
least so many bytes before the end of what has been read stays whatever follows, and is emitted;
the bytes after it are all the state that is kept.

A text goes through ``StreamEncoder`` block by block. A piece of the vocabulary's pattern ends every
merge, so a piece that is followed by three more characters is stable, and the ids of short pieces
are looked up; a piece of more than ``_LONG`` characters goes through ``PieceTransducer``, which needs
the lookahead. What is kept is a block, a piece's last bytes and a cache of bounded bytes.

*Decoding.* Ids become bytes block by block, and bytes become text in an incremental UTF-8 decoder,
which holds at most 3 bytes between blocks. Invalid bytes become U+FFFD.

Defined cases: a null text is empty and has no ids; a null id stays null; repeated rows are encoded each;
an empty table gives none; a special token in a text is one token, as the library has it; white space
and runs of any length are streamed in blocks. Columns other than id and text, whatever their names,
are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from array import array
from functools import lru_cache
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space as the pattern of the tokenizer means it.
_WS = "\t-\r \x85\xa0  -     　"
_PIECE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)
#: The rest of a run whose piece has begun, by kind.
_RUNS = {
    "letter": regex.compile(r"\p{L}*"), "number": regex.compile(r"\p{N}*"),
    "space": regex.compile(rf"[{_WS}]*"), "other": regex.compile(rf"[^{_WS}\p{{L}}\p{{N}}]*"),
}
#: The same pattern for ASCII texts and texts of these characters, in a faster library, words first.
_PLAIN = re.compile(r"[\x00-~À-ÖØ-öø-ɏ]*")
_PLAIN_PIECE = re.compile(
    r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\t-\r A-Za-z0-9À-ÖØ-öø-ɏ]+"
    r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
#: (bytes of pieces, neighbours) that a process keeps: where texts are only hashed, and where rows of ids are
#: handed on by workers that stand beside those of earlier stages.
_LARGE, _SMALL = (48 << 20, 1 << 18), (16 << 20, 1 << 16)
_ENTRY = 200  # bytes of a cached piece besides its characters
_LONG = 256
_BLOCK = 1 << 16
_ROWS_BYTES = 1 << 20  # text whose ids are handed on at once


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files: printable ones for themselves, the
    other bytes, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges: Iterable[tuple[bytes, bytes]]) -> int:
    """Bytes after which no merge can be undone by what follows."""
    reach: dict[bytes, int] = {}
    most = 1
    for left, right in merges:
        own = max(
            len(left) + len(right),
            reach.get(left, 0),
            len(left) + reach.get(right, len(right)),
        )
        reach[left] = max(reach.get(left, len(left)), own)
        reach[right] = max(reach.get(right, len(right)), own - len(left))
        reach[left + right] = max(reach.get(left + right, 0), own)
        most = max(most, own)
    return most


class Vocabulary:
    """Tokens, merges and the compatibility of neighbours."""

    def __init__(self, path: str, pairs: int = _SMALL[1]):
        self.pairs = pairs
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if (model.get("type") != "BPE" or before.get("type") != "ByteLevel" or spec.get("normalizer")
                or before.get("add_prefix_space") or not before.get("use_regex", True)
                or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError(f"{path}: not a byte-level BPE without normaliser and prefix space")
        alphabet = byte_alphabet()
        to_bytes = lambda s: bytes(alphabet[c] for c in s)
        ids = {to_bytes(t): i for t, i in model["vocab"].items()}
        pairs = [tuple(map(to_bytes, m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.lookahead = sufficient_lookahead(pairs)
        self.single = [ids.get(bytes([b]), -1) for b in range(256)]
        self.spelled = {i: t for t, i in ids.items()}
        self.tokens = {t: i for t, i in ids.items() if self.merged(t) == [i]}  # those that occur
        self._next: dict[int, int] = {}  # (node << 8 | byte) -> node of the trie of tokens
        self._token_at = [-1]
        for token, i in self.tokens.items():
            node = 0
            for byte in token:
                node = self._next.setdefault(node << 8 | byte, len(self._token_at))
                if node == len(self._token_at):
                    self._token_at.append(-1)
            self._token_at[node] = i
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.spelled |= {i: t.encode() for t, i in self.special.items()}
        self.special_pattern = regex.compile(
            "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)"
        )
        self.code = "H" if max(self.spelled) < 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        self._compatible: dict[tuple[int, int], bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """The definition: apply the first merge of the list that applies, leftmost, until none does."""
        parts = [self.single[b] for b in data]
        while len(parts) > 1:
            found = [(self.merges[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.merges]
            if not found:
                break
            _, at = min(found)
            parts[at : at + 2] = [self.merges[parts[at], parts[at + 1]][1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        known = self._compatible.get((left, right))
        if known is None:
            if len(self._compatible) >= self.pairs:
                self._compatible.clear()
            known = self.merged(self.spelled[left] + self.spelled[right]) == [left, right]
            self._compatible[left, right] = known
        return known

    def _beginnings(self, data: bytes, at: int) -> list[tuple[int, int]]:
        """(end, token) of the tokens that data[at:] begins with, the longest last."""
        out, node, follow, token_at = [], 0, self._next, self._token_at
        for i in range(at, len(data)):
            node = follow.get(node << 8 | data[i])
            if node is None:
                break
            if token_at[node] >= 0:
                out.append((i + 1, token_at[node]))
        return out

    def encode_piece(self, data: bytes) -> list[int]:
        """The tokens of one piece, from left to right."""
        whole = self.tokens.get(data)
        if whole is not None:
            return [whole]
        end, known = len(data), self._compatible
        out: list[int] = []
        open_: list[tuple[int, list]] = []  # where each token begins, and what else could stand there
        dead: set[int] = set()
        at, before, choices = 0, -1, self._beginnings(data, 0)
        while at < end:
            while choices:
                stop, token = choices.pop()
                if stop in dead:
                    continue
                if before < 0:
                    break
                fits = known.get((before, token))
                if fits or fits is None and self.compatible(before, token):
                    break
            else:  # the encoding of data[:at] cannot go on: it is no part of the whole
                dead.add(at)
                at, choices = open_.pop()
                out.pop()
                before = out[-1] if out else -1
                continue
            open_.append((at, choices))
            out.append(token)
            at, before = stop, token
            if at < end:
                choices = self._beginnings(data, at)
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str, pairs: int = _SMALL[1]) -> Vocabulary:
    """The vocabulary of a file, once per process."""
    return Vocabulary(path, pairs)


@lru_cache(maxsize=4)
def encoder(path: str, kept: tuple[int, int] = _SMALL) -> Encoder:
    """The encoder of a file, with its caches, once per process."""
    return Encoder(vocabulary(path, kept[1]), kept[0])


class PieceTransducer:
    """Feeds on the bytes of one piece and emits its tokens as they become stable."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.rest = vocabulary, b""

    def feed(self, data: bytes) -> list[int]:
        self.rest += data
        if len(self.rest) < 4 * self.vocabulary.lookahead:
            return []
        found, at, out = self.vocabulary.encode_piece(self.rest), 0, []
        for token in found:
            size = len(self.vocabulary.spelled[token])
            if at + size > len(self.rest) - self.vocabulary.lookahead:
                break
            out.append(token)
            at += size
        self.rest = self.rest[at:]
        return out

    def close(self) -> list[int]:
        out, self.rest = self.vocabulary.encode_piece(self.rest), b""
        return out


class StreamEncoder:
    """Encodes a text that comes in parts of any size, in memory that does not depend on it.

    Ids come as the bytes of an array of the vocabulary's type.
    """

    def __init__(self, vocabulary: Vocabulary, known: PieceCache):
        self.vocabulary, self.known = vocabulary, known
        self.tail = ""  # may begin a special token
        self.text = ""  # no special token in it
        self.run: tuple[str, PieceTransducer] | None = None

    def feed(self, part: str, last: bool = False) -> bytes:
        out: list[bytes] = []
        self.tail += part
        if any(special in self.tail for special in self.vocabulary.special):
            while match := self.vocabulary.special_pattern.search(self.tail):
                self.text += self.tail[: match.start()]
                out += [self._pieces(True), self._ids([self.vocabulary.special[match.group()]])]
                self.tail = self.tail[match.end() :]
        ready = len(self.tail) - (0 if last else self._begun())
        self.text, self.tail = self.text + self.tail[:ready], self.tail[ready:]
        return b"".join([*out, self._pieces(last)])

    def _begun(self) -> int:
        """How many characters at the end of the tail may begin a special token."""
        return max((n for s in self.vocabulary.special for n in range(1, len(s)) if self.tail.endswith(s[:n])), default=0)

    def _ids(self, ids: list[int]) -> bytes:
        return array(self.vocabulary.code, ids).tobytes()

    def _pieces(self, last: bool) -> bytes:
        out: list[bytes] = []
        while True:
            if self.run:
                out.append(self._go_on(last))
                if self.run:
                    break
            found = split_pieces(self.text)
            rest = 0
            while not last and found and rest < 3:  # 're could still become one
                rest += len(found.pop())
            out.append(self.known.join(found, self._encoded))
            self.text = self.text[len(self.text) - rest :] if rest else ""
            if len(self.text) <= _LONG:
                break
            self._begin()
        return b"".join(out)

    def _begin(self) -> None:
        """A long piece has begun; its kind tells where it ends."""
        first, body = self.text[0], self.text.lstrip(" ")[:1] or " "
        spaces = regex.match(f"[{_WS}]{{2}}", self.text) or regex.match(f"[{_WS}]", body) or first != " " and regex.match(f"[{_WS}]", first)
        kind = ("space" if spaces else "letter" if regex.match(r"\p{L}", body)
                else "number" if regex.match(r"\p{N}", body) else "other")
        self.run = (kind, PieceTransducer(self.vocabulary))
        if kind != "space" and first == " ":
            self.run[1].rest, self.text = b" ", self.text[1:]

    def _go_on(self, last: bool) -> bytes:
        kind, piece = self.run
        out: list[int] = []
        end = _RUNS[kind].match(self.text).end()
        over = last or end < len(self.text)
        if kind == "space" and not (last and end == len(self.text)):
            end = max(0, end - 1)  # the last one belongs to what follows
        data = self.text[:end].encode()
        step = 4 * self.vocabulary.lookahead
        for i in range(0, len(data), step):
            out += piece.feed(data[i : i + step])
        self.text = self.text[end:]
        if over:
            out += piece.close()
            self.run = None
        return self._ids(out)

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        one = self.vocabulary.encode_piece
        return [self._ids(one(p.encode())) if len(p) <= _LONG else self._long(p.encode()) for p in pieces]

    def _long(self, data: bytes) -> bytes:
        transducer, out = PieceTransducer(self.vocabulary), []
        step = 4 * self.vocabulary.lookahead
        for i in range(0, len(data), step):
            out.append(self._ids(transducer.feed(data[i : i + step])))
        return b"".join([*out, self._ids(transducer.close())])


def split_pieces(text: str) -> list[str]:
    """The pieces of a text without special tokens. Each is encoded as it is on its own."""
    return (_PLAIN_PIECE if text.isascii() or _PLAIN.fullmatch(text) else _PIECE).findall(text)


class PieceCache:
    """The ids of pieces, in two generations of at most ``most`` bytes each; what is asked for again stays."""

    def __init__(self, most: int):
        self.most, self.held, self.young, self.old = most, 0, {}, {}

    def join(self, pieces: list[str], encode: Callable[[list[str]], list[bytes]]) -> bytes:
        """The ids of all pieces, one after the other; ``encode`` is asked for those not known."""
        young, old = self.young, self.old
        found = list(map(young.get, pieces))
        if None not in found:
            return b"".join(found)
        gaps = [i for i, ids in enumerate(found) if ids is None]
        new = {pieces[i] for i in gaps}
        young.update([(p, old[p]) for p in new if p in old])
        asked = [p for p in new if p not in young]
        young.update(zip(asked, encode(asked)))
        for i in gaps:
            found[i] = young[pieces[i]]
        ids = b"".join(found)
        for piece in new:
            if len(piece) > _LONG:
                del young[piece]
            else:
                self.held += _ENTRY + 4 * len(piece)
        if self.held >= self.most:
            self.young, self.old, self.held = {}, young, 0
        return ids


class Encoder:
    """Texts to ids, block by block; pieces that come again are looked up."""

    def __init__(self, vocabulary: Vocabulary, cache_bytes: int = _SMALL[0]):
        self.vocabulary = vocabulary
        self.known = PieceCache(cache_bytes)

    def stream(self, text: str | None) -> Iterator[np.ndarray]:
        """The ids of a text, in parts, each as soon as it is stable."""
        text, stream = text or "", StreamEncoder(self.vocabulary, self.known)
        for i in range(0, len(text), _BLOCK):
            ids = stream.feed(text[i : i + _BLOCK], i + _BLOCK >= len(text))
            yield np.frombuffer(ids, self.vocabulary.dtype)

    def encode(self, text: str | None) -> np.ndarray:
        return np.concatenate([np.zeros(0, self.vocabulary.dtype), *self.stream(text)])


class Speller:
    """Replaces ids by byte strings, in array operations."""

    def __init__(self, strings: dict[int, bytes]):
        top = max(strings) + 1
        parts = [strings.get(i, b"") for i in range(top)]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def spell(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.data[at].tobytes()


class Decoder:
    """Ids to text in blocks of ``_BLOCK`` ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.speller = Speller(vocabulary.spelled)

    def stream(self, ids: Iterable[np.ndarray]) -> Iterator[str]:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for block in ids:
            for i in range(0, len(block), _BLOCK):
                yield machine.decode(self.speller.spell(block[i : i + _BLOCK]))
        yield machine.decode(b"", True)

    def decode(self, ids: np.ndarray) -> str:
        return "".join(self.stream([ids]))


def decimals(vocabulary: Vocabulary) -> Speller:
    """Ids as decimal numbers, each with a comma behind it."""
    return Speller({i: f"{i},".encode() for i in vocabulary.spelled})


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for every row; ``ids`` is an array of int."""
    return encode_checked(docs, path, id_col, text_col).select("id", "ids")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) for every row of ids; null ids are none."""
    def run(batches):
        decoder = Decoder(vocabulary(path))
        for batch in batches:
            texts = [decoder.decode(np.array(x or [], np.int64)) for x in batch["ids"].to_pylist()]
            yield pa.record_batch({"id": batch["id"], "text": pa.array(texts, pa.string())})

    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, "id long, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): each text encoded, its ids decoded, both hashed.

    One pass without a shuffle; a text is encoded, listed and decoded block by block, and neither ids
    nor decoded texts leave the task or are held whole.
    """
    def run(batches):
        known = encoder(path, _LARGE)
        stream, speller, digits = known.stream, Decoder(known.vocabulary).speller, decimals(known.vocabulary)
        for batch in batches:
            sizes, ids_digest, text_digest = [], [], []
            for text in batch["text"]:
                listed, decoded, n = hashlib.sha256(), hashlib.sha256(), 0
                machine = codecs.getincrementaldecoder("utf-8")("replace")
                for ids in stream(text.as_py()):
                    if len(ids):
                        block = digits.spell(ids)[:-1]
                        listed.update(b"," + block if n else block)
                        decoded.update(machine.decode(speller.spell(ids)).encode())
                        n += len(ids)
                decoded.update(machine.decode(b"", True).encode())
                sizes.append(n)
                ids_digest.append(listed.hexdigest())
                text_digest.append(decoded.hexdigest())
            yield pa.record_batch({
                "id": batch["id"], "n_tokens": pa.array(sizes, pa.int64()),
                "ids_sha256": pa.array(ids_digest, pa.string()),
                "decoded_sha256": pa.array(text_digest, pa.string()),
            })

    return _texts(docs, id_col, text_col).mapInArrow(
        run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode_checked(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, restored): the ids of each text, and whether they decode to it.

    Rows go on as soon as they stand for ``_ROWS_BYTES`` of text, whatever the size of the batch they
    came in. The ids of one text are one value, so the longest text bounds what a task holds.
    """
    def run(batches):
        known = encoder(path)
        speller = Decoder(known.vocabulary).speller

        def block(ids, rows, restored):
            return pa.record_batch({
                "id": pa.array(ids, pa.int64()), "n_tokens": pa.array([len(r) for r in rows], pa.int64()),
                "ids": _lists(rows), "restored": pa.array(restored, pa.bool_()),
            })

        for batch in batches:
            held, out = 0, ([], [], [])
            for i, value in zip(batch["id"], batch["text"]):
                text = value.as_py() or ""
                parts, at, same = [np.zeros(0, known.vocabulary.dtype)], 0, True
                machine = codecs.getincrementaldecoder("utf-8")("replace")
                for ids in known.stream(text):
                    parts.append(ids)
                    back = machine.decode(speller.spell(ids))
                    same, at = same and text.startswith(back, at), at + len(back)
                back = machine.decode(b"", True)
                for column, x in zip(out, (i.as_py(), np.concatenate(parts), same and text[at:] == back)):
                    column.append(x)
                held += len(text)
                if held >= _ROWS_BYTES:
                    yield block(*out)
                    held, out = 0, ([], [], [])
            if out[0]:
                yield block(*out)

    return _texts(docs, id_col, text_col).mapInArrow(
        run, "id long, n_tokens long, ids array<int>, restored boolean"
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate([np.zeros(0, np.int32), *rows]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
