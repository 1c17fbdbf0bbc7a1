"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies."""

from __future__ import annotations

import hashlib
import re
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparrowmill.llm.text import text_slices

SPACE_MARK = "▁"
#: Words and segments of words that a Python worker remembers at most, under 300 bytes each.
REMEMBERED = 300_000
#: Up to this many characters the agenda is a plain list, which is then faster than a heap.
SHORT = 24
NO_PAIR = float("inf")
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)


class PieceBpe:
    """Encoder and decoder of one model, given as the bytes of its file.

    A segment is merged from its characters: an agenda holds adjacent pairs that form a piece, and the
    pair with the best score, the leftmost of equal ones, is merged next. Characters without a piece
    become byte pieces.

    A text is cut into segments where no piece could reach across: letters, other signs and digits run
    apart, each with the space marks before it, and ASCII characters that are in no longer piece stand
    alone. That holds if every piece is one segment itself, which is tried for each model; otherwise
    texts are cut before space marks only, or not at all. So a segment's ids do not depend on its
    neighbours, and what occurred before is looked up: first whole words between single spaces, then
    the segments of new words.
    """

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        rules = proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != 2 or kinds & {USER_DEFINED, UNUSED} or BYTE not in kinds:
            raise ValueError("only merge-type vocabularies with byte fallback and without reserved pieces")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that keep the text as it is")
        self.prefix = SPACE_MARK if rules.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.score = {p.piece: -p.score for p in proto.pieces if p.type == NORMAL}
        bytes_ = [i for i, p in enumerate(proto.pieces) if p.type == BYTE]
        self.byte_id = {int(self.pieces[i][3:-1], 16): i for i in bytes_}
        self.end = self.library.eos_id()
        self.cut = self._cutter([p for p in self.ids if len(p) > 1])
        self.segments = _Remembered(self._new_segment)
        self.words = _Remembered(self._new_word)
        self.texts = _Remembered(self._show)
        self.fresh: list[str] = []
        # a byte above 0x7F stands as a lone surrogate until its run is complete
        self.shown = {str(i): p.replace(SPACE_MARK, " ") for i, p in enumerate(self.pieces)}
        self.shown |= {str(i): bytes([b]).decode("utf-8", "surrogateescape") for b, i in self.byte_id.items()}
        self.shown |= {str(i): "" for i, p in enumerate(proto.pieces) if p.type == CONTROL}
        self.shown[str(self.library.unk_id())] = self.library.decode([self.library.unk_id()])

    @staticmethod
    def _cutter(long: list[str]):
        joined = {c for p in long for c in p}
        lone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined)
        alone = f"[{lone}]|" if lone else ""
        m, raised = SPACE_MARK, "²³¹"
        for pattern in (
            rf"{alone}{m}*[^\W\d_{raised}]+|{m}*(?:[^\w{m}{lone}]|[_{raised}])+|{m}*\d+|{m}+|[\s\S]",
            rf"{m}+[^{m}]*|[^{m}]+",
        ):
            cut = re.compile(pattern).findall
            if all(len(cut(p)) == 1 for p in long):
                return cut
        return lambda text: [text]

    def _new_segment(self, segment: str) -> str:
        self.fresh.append(segment)
        return " ".join(map(str, self.merge(segment)))

    def _new_word(self, word: str) -> str:
        return " ".join(map(self.segments.__getitem__, self.cut(SPACE_MARK + word)))

    def _show(self, ids: str) -> str:
        return "".join(map(self.shown.__getitem__, ids.split()))

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment by the agenda of adjacent pairs."""
        parts = self._merge_short(list(segment)) if len(segment) <= SHORT else self._merge_long(list(segment))
        out = []
        for part in parts:
            if part:
                i = self.ids.get(part)
                if i is not None:
                    out.append(i)
                else:
                    out.extend(self.byte_id[b] for b in part.encode())
        return out

    def _merge_short(self, parts: list[str]) -> list[str]:
        score, none = self.score.get, NO_PAIR
        agenda = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while agenda and (best := min(agenda)) is not none:
            at = agenda.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del agenda[at]
            if at < len(agenda):
                agenda[at] = score(parts[at] + parts[at + 1], none)
            if at:
                agenda[at - 1] = score(parts[at - 1] + parts[at], none)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        score, last = self.score, len(parts) - 1
        left, right = list(range(-1, last)), list(range(1, last + 2))
        agenda: list[tuple] = []

        def offer(a: int, b: int) -> None:
            joined = parts[a] + parts[b]
            if joined in score:
                heappush(agenda, (score[joined], a, b, len(joined)))

        for i in range(last):
            offer(i, i + 1)
        while agenda:
            _, a, b, length = heappop(agenda)
            if not parts[a] or not parts[b] or right[a] != b or len(parts[a]) + len(parts[b]) != length:
                continue  # one of the two was merged with another symbol meanwhile
            parts[a] += parts[b]
            parts[b] = ""
            right[a] = right[b]
            if right[a] <= last:
                left[right[a]] = a
                offer(a, right[a])
            if left[a] >= 0:
                offer(left[a], a)
        return parts

    def check(self, segments: list[str]) -> None:
        """Hold segments not seen before against the library."""
        for s, want in zip(segments, self._by_library(segments)):
            if self.segments[s] != " ".join(map(str, want)):
                raise RuntimeError(f"encoding of {s!r} differs from the library: {self.segments[s]} and {want}")

    def _by_library(self, segments: list[str]) -> list[list[int]]:
        """The library adds the prefix to each text: leave one out, or cut off a line feed put before."""
        if not self.prefix:
            return self.library.encode(segments, num_threads=1)
        plain = self.library.encode([s[1:] if s[0] == SPACE_MARK and len(s) > 1 else "\n" + s for s in segments], num_threads=1)
        head = len(self.library.encode("\n"))
        return [ids if s[0] == SPACE_MARK and len(s) > 1 else ids[head:] for s, ids in zip(segments, plain)]

    def encode_batch(self, texts: list[str]) -> list[list[str]]:
        """Ids of each text as decimal numbers joined by spaces, in parts; the last part is the end id."""
        for memory in (self.words, self.segments, self.texts):
            if len(memory) > REMEMBERED:
                memory.clear()
        self.fresh = []
        out = [self._parts(t) for t in texts]
        self.check(self.fresh)
        return out

    def _parts(self, text: str) -> list[str]:
        end = str(self.end)
        if not text:
            return [end]
        if self.prefix and "  " not in text and SPACE_MARK not in text and text[0] != " " and text[-1] != " ":
            return [*map(self.words.__getitem__, text.split(" ")), end]
        return [*map(self.segments.__getitem__, self.cut(self.prefix + text.replace(" ", SPACE_MARK))), end]

    def decode(self, parts: list[str]) -> str:
        """Text of the ids of encode_batch; control ids are silent, runs of byte pieces are UTF-8."""
        text = "".join(map(self.texts.__getitem__, parts))
        if self.prefix and text.startswith(" "):
            text = text[1:]
        if text.isascii():
            return text
        return _utf8(text.encode("utf-8", "surrogateescape"))


class _Remembered(dict):
    """A dict that makes what it does not hold."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> str:
        value = self[key] = self.make(key)
        return value


def _utf8(run: bytes) -> str:
    """Bytes as text; each byte that is not part of a valid character becomes U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            try:
                out.append(run[at:at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_MODELS: dict[str, PieceBpe] = {}


def coder(model: bytes) -> PieceBpe:
    """The coder of a model, one per Python worker, so that tasks share what is remembered."""
    name = hashlib.sha256(model).hexdigest()
    if name not in _MODELS:
        _MODELS[name] = PieceBpe(model)
    return _MODELS[name]


def encode_documents(df: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", full: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256; with `full` also ids and decoded.

    Ids are those of the sentencepiece library without sampling, with one end id, decoded again from the
    ids. The vocabulary file is read on the driver and broadcast (half a MB for 32,000 pieces).
    Nothing is shuffled. Each segment met for the first time in a worker is checked against the library,
    in Arrow batches; a difference ends the job.

    Null text counts as empty: only the end id, decoded to empty text. Ids of rows may be null or
    repeat. Extra columns are ignored; an empty table gives an empty result.
    """
    with open(model_file, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if full:
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]

    def encode(batches):
        bpe = coder(model.value)
        for batch in batches:
            for part, texts in text_slices(batch):
                rows = [[] for _ in fields]
                for parts in bpe.encode_batch([t or "" for t in texts]):
                    ids, decoded = " ".join(parts), bpe.decode(parts)
                    row = [
                        ids.count(" ") + 1,
                        hashlib.sha256(ids.encode()).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest(),
                    ]
                    if full:
                        row += [list(map(int, ids.split())), decoded]
                    for out, value in zip(rows, row):
                        out.append(value)
                arrays = [pa.array(r, kind) for r, (_, kind) in zip(rows, fields)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *arrays], ["doc_id", *(name for name, _ in fields)]
                )

    kind = df.select(F.col(key)).schema[0].dataType.simpleString()
    made = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if full else "")
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, f"doc_id {kind}, {made}")
