"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The symbols of many words lie in one flat numpy array. A round takes, per word,
the least rank of its adjacent pairs (a segmented minimum), merges all leftmost
occurrences of pairs of that rank at once, drops the swallowed symbols and looks
up only the pairs that changed. Words without a pair leave the array.

Why that equals merging one pair at a time, best score first, leftmost first: a
merge can only be overtaken by a pair that holds the new piece. Pieces where
such a pair ranks no worse than the piece itself are found from the vocabulary
(``unsafe``); a word that would merge two of them at once is redone with a heap,
one merge at a time.

Texts split into words before each space that follows another character and
around line feeds; the vocabulary is checked for pieces that would cross such a
border. Models: BPE, byte fallback, identity normaliser, dummy prefix, white
space kept. The sentencepiece library only reads the vocabulary.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SPACE = "▁"
NEVER = np.int32(2**31 - 1)
WORD = re.compile(r" *[^ \n]+| +|\n")
#: Distinct words that a task keeps encoded; beyond it the store starts anew.
STORE_WORDS = 500_000
#: Characters that a task splits into words at a time.
BLOCK_CHARS = 1_000_000


class PieceModel:
    """Vocabulary, ranks and merge table of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        self.control = {i for i in special if not sp.is_byte(i)}
        self.byte_id = np.zeros(256, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(pieces[i][1:-1], 16)] = i
        normal = {p: i for i, p in enumerate(pieces) if i not in special}
        if any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in normal):
            raise ValueError("a piece crosses a word border: this model needs another word rule")
        # symbols: pieces by id, then characters that only occur inside pieces
        symbol = dict(normal)
        for p in normal:
            for c in p:
                symbol.setdefault(c, n + len(symbol) - len(normal))
        self.n_pieces = n
        self.symbol_of = np.full(0x110000, -1, np.int64)  # code point -> symbol
        for s, i in symbol.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        self.symbol_of[ord(" ")] = self.symbol_of[ord(SPACE)]
        self.chars = {i: s for s, i in symbol.items() if len(s) == 1}
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for p, i in normal.items() if len(p) > 1}, reverse=True))}
        rank = {i: order[sp.get_score(i)] for p, i in normal.items() if len(p) > 1}
        self.base = n + len(symbol) - len(normal)
        pairs, unsafe = [], np.zeros(self.base, bool)
        ranked = np.bincount(list(rank.values()) or [0])
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    pairs.append((a * self.base + b, rank[i], i))
                    for part in (a, b):
                        if part in rank and rank[i] <= rank[part]:
                            unsafe[part] = True
            if len(p) > 1 and ranked[rank[i]] > 1:
                unsafe[i] = True
        pairs.sort()
        self.unsafe = unsafe
        self.pair_key = np.array([x[0] for x in pairs] or [-1], np.int64)
        self.pair_rank = np.array([x[1] for x in pairs] or [NEVER], np.int32)
        self.pair_piece = np.array([x[2] for x in pairs] or [0], np.int64)
        self.pair = {k: (r, i) for k, r, i in pairs}
        # bytes of each piece, flat, for decoding
        out = []
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                out.append(bytes([int(p[1:-1], 16)]))
            elif i in self.control:
                out.append(" ⁇ ".encode() if i == self.unk else b"")
            else:
                out.append(p.replace(SPACE, " ").encode())
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.piece_bytes = out
        self.out_len = np.array([len(x) for x in out], np.int64)
        self.out_at = np.concatenate([[0], np.cumsum(self.out_len)])[:-1]
        self.out_flat = np.frombuffer(b"".join(out), np.uint8)
        self.spaced = np.array([i not in special and p.startswith(SPACE) for i, p in enumerate(pieces)])

    # -- encoding -----------------------------------------------------------

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair; symbols under 0 merge with nothing."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        hit = (self.pair_key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_rank[at], NEVER), self.pair_piece[at]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, ids per word). No word is empty."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        point = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        sym = self.symbol_of[point]
        sym = np.where(sym < 0, -1 - point, sym)
        word = np.repeat(np.arange(len(words)), size)
        done_sym, done_word = [], []
        again = np.zeros(len(words), bool)
        same = word[:-1] == word[1:]
        rank = np.full(len(sym), NEVER, np.int32)
        piece = np.zeros(len(sym), np.int64)
        at = np.flatnonzero(same)
        rank[at], piece[at] = self._look(sym[at], sym[at + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            count = np.diff(np.append(first, len(sym)))
            least = np.minimum.reduceat(rank, first)
            live = least != NEVER
            if not live.all():  # these words are done: they leave the array
                out = np.repeat(~live, count)
                done_sym.append(sym[out])
                done_word.append(word[out])
                sym, word, rank, piece = sym[~out], word[~out], rank[~out], piece[~out]
                least, count = least[live], count[live]
                if not len(sym):
                    break
            mark = rank == np.repeat(least, count)
            # of overlapping occurrences every second one, from the left
            at = np.flatnonzero(mark)
            new_run = np.concatenate([[True], np.diff(at) != 1])
            run_at = at[new_run][np.cumsum(new_run) - 1]
            at = at[(at - run_at) % 2 == 0]
            made = piece[at]
            # two at once of a piece that a pair with it may overtake: redo by heap
            owner = word[at]
            risky = self.unsafe[made]
            if risky.any():
                several = np.concatenate([[False], owner[1:] == owner[:-1]])
                several[:-1] |= several[1:].copy()
                again[owner[several & risky]] = True
            sym[at] = made
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            touched = np.zeros(len(sym), bool)
            touched[at] = True
            before = at - 1
            # the symbol before may have been swallowed: then its left neighbour is the new piece
            before = np.where((before >= 0) & ~keep[before], before - 1, before)
            touched[before[before >= 0]] = True
            sym, word, rank, piece, touched = sym[keep], word[keep], rank[keep], piece[keep], touched[keep]
            at = np.flatnonzero(touched)
            rank[at] = NEVER
            at = at[at + 1 < len(sym)]
            at = at[word[at] == word[at + 1]]
            rank[at], piece[at] = self._look(sym[at], sym[at + 1])
        sym = np.concatenate(done_sym) if done_sym else np.zeros(0, np.int64)
        word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
        if again.any():
            fine = ~again[word]
            sym, word = sym[fine], word[fine]
            for w in np.flatnonzero(again):
                redone = self._by_heap(words[w])
                sym = np.concatenate([sym, redone])
                word = np.concatenate([word, np.full(len(redone), w)])
        back = np.argsort(word, kind="stable")
        return self._to_ids(sym[back], word[back], len(words))

    def _by_heap(self, text: str) -> np.ndarray:
        """One merge at a time: best rank first, then leftmost."""
        sym = [int(s) if (s := self.symbol_of[ord(c)]) >= 0 else -1 - ord(c) for c in text]
        right, left = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        heap = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(sym) and (hit := self.pair.get(sym[i] * self.base + sym[j])) and sym[i] >= 0 <= sym[j]:
                heapq.heappush(heap, (hit[0], i, j, sym[i], sym[j], hit[1]))

        for i in range(len(sym) - 1):
            offer(i, i + 1)
        gone = [False] * len(sym)
        while heap:
            _, i, j, a, b, made = heapq.heappop(heap)
            if gone[i] or gone[j] or sym[i] != a or sym[j] != b or right[i] != j:
                continue
            sym[i], gone[j], right[i] = made, True, right[j]
            if right[j] < len(sym):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return np.array([s for s, g in zip(sym, gone, strict=True) if not g], np.int64)

    def _to_ids(self, sym: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols to ids; characters outside the vocabulary become their UTF-8 bytes."""
        other = (sym < 0) | (sym >= self.n_pieces)
        if not other.any():
            return sym, np.bincount(word, minlength=n)
        kinds, which = np.unique(sym[other], return_inverse=True)
        raw = [(chr(-1 - k) if k < 0 else self.chars[k]).encode() for k in kinds.tolist()]
        wide = np.array([len(r) for r in raw], np.int64)
        size = np.ones(len(sym), np.int64)
        size[other] = wide[which]
        out = np.repeat(sym, size)
        word = np.repeat(word, size)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        start = np.concatenate([[0], np.cumsum(wide)])[:-1][which]
        out[np.repeat(other, size)] = self.byte_id[flat[spans(start, wide[which])]]
        return out, np.bincount(word, minlength=n)

    # -- decoding -----------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        """The library's decode(ids): dummy prefix off, byte runs joined, bad bytes as U+FFFD."""
        ids = np.asarray(ids, np.int64)
        raw = self.out_flat[spans(self.out_at[ids], self.out_len[ids])].tobytes()
        ends = (ids == self.bos) | (ids == self.eos)
        body = ids[~ends]
        if len(body) and self.spaced[body[0]]:
            raw = raw[1:]
        if not ends[1:-1].any():  # an end inside parts the bytes around it
            try:
                return raw.decode()
            except UnicodeDecodeError:
                pass
        return self._decode_slowly(ids)

    def _decode_slowly(self, ids: np.ndarray) -> str:
        """Piece by piece, with every byte that is no part of a character as U+FFFD."""
        out, run, first = [], bytearray(), True

        def flush() -> None:
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at:at + n]).decode())
                        at += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()

        for i in ids.tolist():
            if self.is_byte[i]:
                run += self.piece_bytes[i]
            else:
                flush()
                out.append(self.piece_bytes[i].decode()[1 if first and self.spaced[i] else 0:])
            first = first and i in (self.bos, self.eos)
        flush()
        return "".join(out)


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions start[i] .. start[i] + size[i] - 1 of all i, one after another."""
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(size)
    return np.arange(total) + np.repeat(start - (ends - size), size)


class _Numbers(dict):
    """Word -> number in order of first sight; new words are kept in ``fresh``."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


class TextCoder:
    """Encodes texts, with a store of the words seen so far in this task."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.number = _Numbers()
        self.flat, self.size, self.start = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per word) of words in order."""
        if len(self.number) > STORE_WORDS:
            self._reset()
        num = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        if self.number.fresh:
            flat, size = self.model.encode_words(self.number.fresh)
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, flat])
            self.number.fresh = []
        size = self.size[num]
        return self.flat[spans(self.start[num], size)], size

    def _blocks(self, text: str) -> Iterator[str]:
        """Parts of about BLOCK_CHARS that end where a word ends."""
        at = 0
        while len(text) - at > BLOCK_CHARS:
            cut = at + BLOCK_CHARS
            while cut < len(text) and not (text[cut] == "\n" or (text[cut] == " " and text[cut - 1] != " ")):
                cut += 1
            yield text[at:cut]
            at = cut
        yield text[at:]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without begin and end."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        pending: list[tuple[int, list[str]]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            ids, size = self._words([w for _, ws in pending for w in ws])
            ends = np.concatenate([[0], np.cumsum(size)])
            at = 0
            for t, ws in pending:
                out[t].append(ids[ends[at]:ends[at + len(ws)]])
                at += len(ws)
            pending.clear()
            held = 0

        for t, text in enumerate(texts):
            if not text:
                continue
            for block in self._blocks(" " + text.replace(SPACE, " ")):
                pending.append((t, WORD.findall(block)))
                held += len(block)
                if held >= BLOCK_CHARS:
                    flush()
        if pending:
            flush()
        return [np.concatenate(parts) if parts else np.zeros(0, np.int64) for parts in out]


def with_ends(model: PieceModel, ids: np.ndarray) -> np.ndarray:
    return np.concatenate([[model.bos], ids, [model.eos]])


def encode_documents(docs, model_path: str, decode: bool = True):
    """doc_id, ids (array<int>, with begin and end) and decoded text of each row.

    ``docs``: doc_id, text; other columns are left out. A null text is empty and
    gives begin and end alone and an empty decoded text. Rows are independent, so
    repeated rows and any doc_id are fine; an empty table gives no rows.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(model_path)
        coder = TextCoder(model)
        for key, texts in text_slices(batches, "doc_id"):
            ids = [with_ends(model, x) for x in coder.encode(texts)]
            yield pa.RecordBatch.from_arrays([
                key, pa.array(ids, pa.list_(pa.int32())),
                pa.array([model.decode(x) for x in ids] if decode else [None] * len(ids), pa.string())],
                ["doc_id", "ids", "decoded"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def token_digests(docs, model_path: str):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row; cases as in ``encode_documents``.

    The digests are made where the ids are, so that neither ids nor texts travel.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(model_path)
        coder = TextCoder(model)
        for key, texts in text_slices(batches, "doc_id"):
            ids = [with_ends(model, x) for x in coder.encode(texts)]
            yield pa.RecordBatch.from_arrays([
                key, pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(model.decode(x).encode()).hexdigest() for x in ids], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def text_slices(batches: Iterable[pa.RecordBatch], key: str, text: str = "text", rows: int = 256):
    """(key column, texts) of at most ``rows`` rows at a time; null texts come as empty."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part.column(key), [x or "" for x in part.column(text).to_pylist()]
