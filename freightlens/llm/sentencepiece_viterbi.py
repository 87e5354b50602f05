"""SentencePiece encoding and decoding by Viterbi search over a trie of marked words.

A text is normalised as the model says (a mark for each space, one more in front) and cut into marked words: a run of
marks and what follows up to the next mark. No piece of such a model reaches over the border of two words, so words
are encoded alone, and only the different words of a batch. Sorted, they form a trie whose nodes are prefixes; going
through it depth first means to keep one column of forward scores and to go on, with each word, from the longest
prefix it shares with the word before. Every prefix is scored once.

Two kinds of model have different lattices:

* unigram: the forward score of a prefix is the best sum of piece scores, the textbook Viterbi.
* byte-pair (the public vocabulary used here): pieces aren't chosen by their sum but by merges in the order of their
  scores. Such an encoding is the one path whose neighbouring pieces merging would leave apart, each two of them by
  themselves. So the transition of two pieces costs nothing if merging their joint text gives back just these two and
  is forbidden otherwise; each prefix then has exactly one path of finite score, which Viterbi keeps, and the result
  equals the library's. Pairs are tried once and remembered in a cache of bounded size.

Characters outside the vocabulary become byte pieces (or the unknown piece); decoding joins pieces, turns byte pieces
back and takes off the mark in front. Null and empty texts have no pieces. A very long text is a batch of its own, and a
very long word takes memory linear in its length. Repeated rows are encoded alike; of equal sums in a unigram model the
longer last piece wins. An empty table has no rows. Extra columns are left out. The model's file is a parameter; its
content travels in the closure (0.5 MB).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stretches, texts_of, tidy

MARK = "▁"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Pairs of pieces that the merge check remembers, and texts' bytes that share a trie.
PAIRS, BATCH_BYTES = 1 << 18, 4 << 20
#: Words whose ids a worker remembers for good: those of two batches, as long as there is room.
WARM = 150_000
#: Longer words aren't remembered for good.
LONG = 256
FORBIDDEN = float("-inf")


class Model:
    """A SentencePiece model's pieces, read from its file's bytes."""

    def __init__(self, proto: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        m.ParseFromString(proto)
        kinds = pb.ModelProto.SentencePiece
        self.kind = {pb.TrainerSpec.UNIGRAM: "unigram", pb.TrainerSpec.BPE: "bpe"}[m.trainer_spec.model_type]
        n = m.normalizer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models whose normalisation is the identity are supported")
        self.prefix = n.add_dummy_prefix
        self.pieces = [p.piece for p in m.pieces]
        self.ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type == kinds.NORMAL}
        self.score = [p.score for p in m.pieces]
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in m.pieces) or any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces of the user's own, unused ones, or pieces over a word's border aren't supported")
        self.unknown = next(i for i, p in enumerate(m.pieces) if p.type == kinds.UNKNOWN)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == kinds.BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.control = {i for i, p in enumerate(m.pieces) if p.type == kinds.CONTROL}
        self.warm: dict[str, tuple[int, ...]] = {}
        self.recent: dict[str, tuple[int, ...]] = {}
        self.surface = [p.replace(MARK, " ") for p in self.pieces]
        for i in self.control:
            self.surface[i] = ""
        self.surface[self.unknown] = " \u2047 "
        for b, i in self.bytes.items():
            self.surface[i] = chr(b) if b < 128 else "\ufffd"
        self.wide = np.zeros(len(self.pieces), bool)
        self.wide[[i for b, i in self.bytes.items() if b >= 128]] = True
        self.least = min((self.score[i] for i in self.ids.values()), default=0.0) - 10.0
        self.automaton, self.longest = ahocorasick.Automaton(), max(map(len, self.ids), default=1)
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.pair: dict[int, bool] = {}
        self.codes = len(self.pieces) + 0x110000

    def fallback(self, char: str, before: list[int]) -> list[int]:
        """A character outside the vocabulary: its bytes, else the unknown piece, once for neighbouring ones in unigram models."""
        if self.bytes:
            return [self.bytes[b] for b in char.encode()]
        return [] if self.kind == "unigram" and before[-1:] == [self.unknown] else [self.unknown]

    def merged(self, symbols: list[str]) -> list[str]:
        """Merges by the best score, the leftmost first, until none is left."""
        symbols = list(symbols)
        while True:
            best, at = FORBIDDEN, -1
            for k in range(len(symbols) - 1):
                i = self.ids.get(symbols[k] + symbols[k + 1])
                if i is not None and self.score[i] > best:
                    best, at = self.score[i], k
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def _free(self, last: int, i: int) -> bool:
        """Whether a merge leaves two pieces apart (last -1: whether it makes the piece at all); remembered."""
        if len(self.pair) >= PAIRS:
            self.pair.clear()
        name = lambda k: self.pieces[k] if k < len(self.pieces) else chr(k - len(self.pieces))
        whole = [name(i)] if last < 0 else [name(last), name(i)]
        got = self.pair[last * self.codes + i] = self.merged(list("".join(whole))) == whole
        return got

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Each different word's ids, by one walk over the sorted words.

        Columns by length of the prefix: best, the forward score; last, the piece that ends its best path (characters
        outside the vocabulary count from the vocabulary's end on); origin, where that piece begins. The pieces that end at
        a place come from an automaton over the vocabulary, longest first. Ids are read back once a word is through, so
        memory is linear in its length.
        """
        found, before = {}, ""
        best, last, origin = [0.0], [-1], [0]
        score, codes, n_pieces, unigram = self.score, self.codes, len(self.pieces), self.kind == "unigram"
        known, ends = self.pair.get, self.automaton.iter
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :], last[shared + 1 :], origin[shared + 1 :]
            done = shared  # prefixes up to here are through
            for end, (i, size) in ends(word, max(0, shared + 1 - self.longest)):
                if end < (shared if unigram else done):
                    continue
                while end > done:  # nothing ends there, or no path is free: the character stands for itself
                    best.append(best[done] + self.least)
                    last.append(n_pieces + ord(word[done]))
                    origin.append(done)
                    done += 1
                start = end + 1 - size
                if unigram:
                    if end == done:  # the first piece that ends here; a character that is no piece can stand for itself too
                        best.append(FORBIDDEN if word[end] in self.ids else best[end] + self.least)
                        last.append(n_pieces + ord(word[end]))
                        origin.append(end)
                        done += 1
                    own = best[start] + score[i]
                    if own > best[-1]:
                        best[-1], last[-1], origin[-1] = own, i, start
                    continue
                free = known(last[start] * codes + i)
                if free is None:
                    free = self._free(last[start], i)
                if free:  # all other paths to here are forbidden
                    best.append(best[start] + score[i])
                    last.append(i)
                    origin.append(start)
                    done += 1
            for at in range(len(best) - 1, len(word)):
                best.append(best[at] + self.least)
                last.append(n_pieces + ord(word[at]))
                origin.append(at)
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at = origin[at]
            ids.reverse()
            if max(ids) >= n_pieces:
                chosen_ids, ids = ids, []
                for i in chosen_ids:
                    ids += [i] if i < n_pieces else self.fallback(chr(i - n_pieces), ids)
            found[word], before = tuple(ids), word
        return found

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        return _WORD.findall((MARK if self.prefix else "") + text.replace(" ", MARK))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's ids. Words become numbers text by text, and numbers ids by arrays, so few objects live at a time."""
        number: dict[str, int] = {}
        rows = [np.fromiter([number.setdefault(w, len(number)) for w in self.words(t)], np.int32) for t in texts]
        again = number.keys() & self.recent.keys()
        if len(self.warm) < WARM:
            self.warm.update((w, self.recent[w]) for w in again if len(w) <= LONG)
        old, self.recent = self.recent, self.encode_words([w for w in number if w not in self.warm and w not in again])
        codes = [self.recent.get(w) or self.warm.get(w) or old[w] for w in number]
        size = np.fromiter(map(len, codes), np.int64, len(codes))
        flat = np.fromiter(chain.from_iterable(codes), np.int32, int(size.sum()))
        start = np.cumsum(size) - size
        out = []
        for row in rows:
            n = size[row]
            out.append(flat[np.repeat(start[row] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of pieces. A byte below 128 is a character of its own; only texts with others are put together byte by byte."""
        if not self.wide[ids].any():
            text = "".join(map(self.surface.__getitem__, ids.tolist()))
        else:
            out, held = [], bytearray()
            for i in ids.tolist():
                if i in self.byte_of:
                    held.append(self.byte_of[i])
                    continue
                if held:
                    out.append(held.decode(errors="replace"))
                    held = bytearray()
                out.append(self.surface[i])
            text = "".join(out) + held.decode(errors="replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_MODELS: dict[int, Model] = {}


def _model(proto: bytes) -> Model:
    key = hash(proto)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(proto)
    return _MODELS[key]


def default_model() -> bytes:
    """The public byte-pair model's file."""
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def encoded(docs: DataFrame, proto: bytes, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, keep..., ids array of int, decoded string): pieces of each whole text, and the text they give back."""

    own = [id_col, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(proto)
        for batch in batches:
            texts = batch.column(text_col)
            for at, upto in stretches(texts, BATCH_BYTES):
                ids = model.encode([t.decode() for t in texts_of(texts.slice(at, upto - at))])
                back = [model.decode(x) for x in ids]
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids]))), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(at, upto - at) for c in own), lists, pa.array(back, pa.string())], [*own, "ids", "decoded"])
        model.recent = {}

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)
    return docs.select(*own, text_col).mapInArrow(tidy(run), f"{kept}, ids array<int>, decoded string")


def op7_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, how many, and a digest of the text that they decode to."""
    found = encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_model())
    return found.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
