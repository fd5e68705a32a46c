"""BPE encoding and decoding by a streaming transducer with bounded lookahead.

The merges alone bound how far a text that is still unread can change earlier tokens. Whether
a pair (a, b) is merged depends on what follows only if b, or the token at its end, is first
taken away by a pair of a lower rank; that pair in turn depends only on pairs of still lower
ranks. So chains end, and `sufficient_lookahead` is the longest of them in symbols. A boundary
with that many symbols behind it is final, and nothing to its right depends on what lies to its
left. The transducer therefore emits tokens as soon as they are stable and holds a window of
fixed length, however long a word is; texts are read in blocks cut where neither the
normaliser nor the splitting pattern looks across.

Decoding is a state machine as well: it holds the bytes of an unfinished character only.

The vocabulary is a file of the tokenizers library with a normaliser of NFC, white space and
lower case, a splitting pattern, byte-level symbols and a word-end suffix. Results equal the
library's encode without added special tokens, and its decode.
"""

from __future__ import annotations

import codecs
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 65_536  # characters of a text worked on at once
WINDOW = 1_024  # symbols a transducer collects beyond the lookahead before it emits
SHORT, NEVER = 24, 2**62  # symbols merged without a queue; the rank of a pair that is not merged
MEMO, MEMO_CHARS = 200_000, 64  # words whose tokens a generation of the memo holds, and their length
FAMILIES = (("L", r"\p{L}"), ("P", r"[^\s\p{L}\p{N}]"))  # runs that a piece may consist of


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes take the code points
    from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(moved)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], length) -> int:
    """Symbols behind a boundary after which no continuation can change it.

    `reach` of a token is how far behind its end its forming depends on the text. It is that
    of its parts, or that of an earlier merge which may take its end away. Merges must be
    listed after those that form their parts; a list of another order is refused.
    """
    reach: dict[str, int] = {}
    taken: dict[str, int] = {}  # by merges so far, whose left part it is
    for a, b in merges:
        for part in (a, b):
            if part not in reach:
                if length(part) != 1:
                    raise ValueError(f"{part} is merged before it is formed")
                reach[part] = 0
        now = max(0, reach[b], reach[a] - length(b), taken.get(b, 0))
        reach[a + b] = max(now, reach.get(a + b, 0))
        taken[a] = max(taken.get(a, 0), length(b) + now)
    return max(taken.values(), default=0)


class Vocabulary:
    """Merges, tokens and special tokens of a vocabulary file's text."""

    def __init__(self, definition: str):
        parts = json.loads(definition)
        model = parts["model"]
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = dict(model["vocab"])
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.lookahead = sufficient_lookahead(pairs, self.length)
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        split = next(p for p in parts["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.piece = regex.compile(split["pattern"]["Regex"])
        self.symbols = byte_symbols()
        self.bytes = {s: b for b, s in enumerate(self.symbols)}

    def length(self, token: str) -> int:
        return len(token) - (len(self.suffix) if token.endswith(self.suffix) else 0)


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Tokens of a sequence of symbols: the pair of the lowest rank first, then the leftmost."""
    parts: list[str | None] = list(symbols)
    if len(parts) <= SHORT:
        get = ranks.get
        found = [get(pair, NEVER) for pair in zip(parts, parts[1:])]
        while found and (least := min(found)) != NEVER:
            i = found.index(least)
            parts[i] += parts.pop(i + 1)
            del found[i]
            if i:
                found[i - 1] = get((parts[i - 1], parts[i]), NEVER)
            if i < len(found):
                found[i] = get((parts[i], parts[i + 1]), NEVER)
        return parts
    end = len(parts)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    queue = [(r, i) for i in range(end - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(queue)
    while queue:
        rank, i = heapq.heappop(queue)
        j = after[i]
        if parts[i] is None or j >= end or ranks.get((parts[i], parts[j])) != rank:
            continue
        parts[i] += parts[j]
        parts[j] = None
        after[i] = after[j]
        if after[i] < end:
            before[after[i]] = i
            if (r := ranks.get((parts[i], parts[after[i]]))) is not None:
                heapq.heappush(queue, (r, i))
        if before[i] >= 0 and (r := ranks.get((parts[before[i]], parts[i]))) is not None:
            heapq.heappush(queue, (r, before[i]))
    return [p for p in parts if p is not None]


class Transducer:
    """Tokens of one piece, emitted once stable. `held` never exceeds lookahead + 2 windows."""

    def __init__(self, vocabulary: Vocabulary, window: int = WINDOW):
        self.vocabulary, self.window, self.held = vocabulary, window, []

    def push(self, text: str) -> list[int]:
        v, out = self.vocabulary, []
        for at in range(0, len(text), self.window // 4 or 1):
            part = text[at : at + (self.window // 4 or 1)].encode("utf-8", "surrogatepass")
            self.held += [v.symbols[b] for b in part]
            # the last symbol may be the last of the piece, so it does not count as read
            if len(self.held) > v.lookahead + self.window + 1:
                last = self.held.pop()
                done = 0
                for token in merged(self.held, v.ranks):
                    if done + v.length(token) + v.lookahead > len(self.held):
                        break
                    done += v.length(token)
                    out.append(v.ids[token])
                self.held = [*self.held[done:], last]
        return out

    def finish(self) -> list[int]:
        v, held = self.vocabulary, self.held
        if not held:
            return []
        self.held = []
        held[-1] += v.suffix
        return [v.ids[token] for token in merged(held, v.ranks)]


class Encoder:
    """Texts to token ids, block by block.

    Ids are 32-bit numbers in bytes, which are joined without a Python object for each.
    """

    def __init__(self, vocabulary: Vocabulary, block: int = BLOCK):
        self.vocabulary, self.block = vocabulary, block
        self.memo: dict[str, bytes] = {}  # of pieces, and of runs of them between blanks
        self.older: dict[str, bytes] = {}  # the generation before, from which known words come back
        self.machine = Transducer(vocabulary)
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))))
        self.runs = {name: regex.compile(f"{family}*") for name, family in FAMILIES}
        self.kinds = [(name, regex.compile(family)) for name, family in FAMILIES]

    def encode(self, text: str | None) -> Iterator[list[int]]:
        """Ids of a text, in lists of one block each; null counts as empty."""
        for packed in self.packed(text):
            yield np.frombuffer(packed, np.int32).tolist()

    def packed(self, text: str | None) -> Iterator[bytes]:
        """The same ids in bytes."""
        text = text or ""
        at = 0
        if self.vocabulary.special:
            for found in self.special.finditer(text):
                yield from self._plain(text, at, found.start())
                yield _pack([self.vocabulary.special[found[0]]])
                at = found.end()
        yield from self._plain(text, at, len(text))

    def _blocks(self, text: str, at: int, end: int) -> Iterator[str]:
        """Normalised blocks. Cuts lie before ASCII characters, which never join what precedes."""
        while at < end:
            stop = min(end, at + self.block)
            while stop < end and ord(text[stop]) > 127:
                stop += 1
            part = unicodedata.normalize("NFC", text[at:stop])
            yield part.replace("Σ", "σ").lower()  # characters one by one: no final sigma
            at = stop

    def _plain(self, text: str, at: int, end: int) -> Iterator[bytes]:
        rest, open_run = "", None  # text not yet split; (transducer, pattern) of a piece still open
        blocks = self._blocks(text, at, end)
        block = next(blocks, None)
        while block is not None:
            following = next(blocks, None)
            found: list[bytes] = []
            if open_run is not None:
                transducer, run = open_run
                stop = run.match(block).end()
                found.append(_pack(transducer.push(block[:stop])))
                if stop == len(block) and following is not None:
                    yield b"".join(found)
                    block = following
                    continue
                found.append(_pack(transducer.finish()))
                open_run, block = None, block[stop:]
            rest += block
            # the last characters may belong to a longer piece
            safe = len(rest) - 3 if following is not None else len(rest)
            kept = len(rest)
            if following is None:
                runs = list(filter(None, rest.replace("\n", " ").split(" ")))  # no piece holds white space
                ids = list(map(self.memo.get, runs))
                if None in ids:
                    ids = [self._run(run) if known is None else known for run, known in zip(runs, ids)]
                found += ids
            else:
                for piece in self.vocabulary.piece.finditer(rest):
                    if piece.end() > safe:
                        kept = piece.start()
                        break
                    found.append(self._word(piece[0]))
            rest = rest[kept:] if following is not None else ""
            if len(rest) > self.block // 2:
                for name, kind in self.kinds:
                    if kind.match(rest) and self.runs[name].match(rest).end() == len(rest):
                        transducer = Transducer(self.vocabulary)
                        found.append(_pack(transducer.push(rest)))
                        open_run, rest = (transducer, self.runs[name]), ""
                        break
            yield b"".join(found)
            block = following
        if open_run is not None:
            yield _pack(open_run[0].finish())

    def _known(self, text: str) -> bytes | None:
        known = self.memo.get(text)
        if known is None and (known := self.older.get(text)) is not None:
            self._remembered(text, known)
        return known

    def _run(self, run: str) -> bytes:
        """Ids of a text between blanks."""
        known = self._known(run)
        if known is None:
            pieces = self.vocabulary.piece.findall(run)
            if pieces == [run]:
                return self._word(run)
            known = self._remembered(run, b"".join([self._word(piece) for piece in pieces]))
        return known

    def _word(self, word: str) -> bytes:
        known = self._known(word)
        if known is None:
            known = self._remembered(word, _pack(self.machine.push(word) + self.machine.finish()))
        return known

    def _remembered(self, text: str, ids: bytes) -> bytes:
        if len(text) <= MEMO_CHARS:
            if len(self.memo) >= MEMO:
                self.older, self.memo = self.memo, {}
            self.memo[text] = ids
        return ids


def _pack(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Decoder:
    """Token ids to text, id by id.

    `tokens` gives what the library gives for a vocabulary without a decoder: the tokens in
    their own symbols, separated by spaces. `text` gives the encoded text itself: symbols to
    bytes, bytes to characters as soon as one is complete, a space for each word end.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pieces: dict[int, bytes] = {}
        for i, token in vocabulary.tokens.items():
            own = i in vocabulary.special.values()
            ends = not own and token.endswith(vocabulary.suffix)
            body = token[: vocabulary.length(token)] if not own else token
            data = token.encode() if own else bytes(vocabulary.bytes[s] for s in body)
            self.pieces[i] = data + b" " if ends or own else data
        ids = range(max(vocabulary.tokens, default=-1) + 1)
        self.table = pa.array([vocabulary.tokens.get(i) for i in ids], pa.string())

    def tokens(self, ids: Iterable[int]) -> str:
        """Ids the vocabulary lacks are passed over, as the library does."""
        known = self.vocabulary.tokens
        return " ".join([known[i] for i in ids if i in known])

    def all_tokens(self, lists: pa.Array) -> pa.Array:
        """`tokens` of a whole array of lists; a null list gives an empty text."""
        flat = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        known = (flat >= 0) & (flat < len(self.table))
        known[known] = self.table.is_valid().to_numpy(zero_copy_only=False)[flat[known]]
        offsets = np.concatenate([[0], np.cumsum(known)])[np.concatenate([[0], ends])]
        tokens = self.table.take(pa.array(flat[known]))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), tokens), " ")

    def text(self, ids: Iterable[int]) -> str:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        parts = [machine.decode(self.pieces.get(i, b"")) for i in ids]
        return ("".join(parts) + machine.decode(b"", True)).removesuffix(" ")


_kept: dict[tuple[str, int], object] = {}


def _once(make, definition: str):
    """What `make` builds from a vocabulary, kept by a worker process for its next tasks."""
    key = (make.__name__, hash(definition))
    if key not in _kept:
        if len(_kept) > 3:
            _kept.clear()
        _kept[key] = make(Vocabulary(definition))
    return _kept[key]


def read_vocabulary(path: str) -> str:
    """The text of a vocabulary file, read where the plan is made and sent to the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _mapped(df: DataFrame, column: str, name: str, kind: pa.DataType, spark_type: str, make) -> DataFrame:
    """`df` with `name` (replaced if present) made from `column` by a function built once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = make()
        for batch in batches:
            *rest, values = batch.columns
            for at in range(0, max(1, len(values)), 500):
                part = change(values.slice(at, 500))
                yield pa.record_batch([*[c.slice(at, 500) for c in rest], part.cast(kind)], [*kept, name])

    kept = [c for c in df.columns if c != name]
    columns = [F.col(f"`{c}`") for c in kept]
    schema = df.select(*columns, F.lit(None).cast(spark_type).alias(name)).schema
    return df.select(*columns, F.col(f"`{column}`").alias("_in")).mapInArrow(run, schema)


def encode(docs: DataFrame, definition: str, text: str = "text") -> DataFrame:
    """`docs` with `ids`, the token ids of the whole text.

    `definition` is the vocabulary file's text (`read_vocabulary`). Null and empty texts have
    no ids. An existing `ids` column is replaced; other columns and repeated rows are kept.
    """

    def make():
        encoder = _once(Encoder, definition)

        def change(texts: pa.Array) -> pa.Array:
            offsets, parts = [0], []
            for value in texts:
                own = 0
                for ids in encoder.packed(value.as_py()):
                    parts.append(ids)
                    own += len(ids) // 4
                offsets.append(offsets[-1] + own)
            flat = np.frombuffer(b"".join(parts), np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))

        return change

    return _mapped(docs, text, "ids", pa.list_(pa.int32()), "array<int>", make)


def decode(encoded: DataFrame, definition: str, ids: str = "ids", form: str = "text") -> DataFrame:
    """`encoded` with `decoded`: the text of the ids, or with form `tokens` the library's form.

    Null ids give an empty text. An existing `decoded` column is replaced.
    """

    def make():
        decoder = _once(Decoder, definition)

        def change(lists: pa.Array) -> pa.Array:
            return pa.array([decoder.text(x or ()) for x in lists.to_pylist()], pa.string())

        return {"text": change, "tokens": decoder.all_tokens}[form]

    return _mapped(encoded, ids, "decoded", pa.string(), "string", make)


def digests(ids: str = "ids", decoded: str = "decoded") -> list[Column]:
    """Counts and digests of encoded and decoded texts."""
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.transform(ids, lambda x: x.cast("string"))), 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    ]
