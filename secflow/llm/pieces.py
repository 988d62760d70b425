"""SentencePiece encoding and decoding with the N best segmentations.

The pieces and scores of a model span a lattice over a text. A forward Viterbi pass gives the best score of every
prefix. These are exact heuristics for an A-star search from the end of the text backwards: a partial segmentation is
worth its own pieces plus the best prefix before them, so complete segmentations leave the queue in order, best first.

No piece of a model goes on behind a word into the next space, so the lattice falls into units: spaces and the word
behind them. Viterbi passes run over all distinct units of a batch at once. The N best segmentations of a text differ
from its best one in the N - 1 units that lose least by their second choice, so the search over a text only opens those.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_SIGN = SPACE.encode()
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Units longer than this are searched one at a time.
LONG = 40
#: Distinct units that a worker remembers, and ids of all segmentations that it gives out at once.
REMEMBERED = 500_000
PART = 1 << 20
#: Characters of texts whose units are learned and looked up together, unless they are too many distinct ones.
TOGETHER = 8 << 20
#: Units whose lattices are held at once.
BATCH = 8192
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MODELS: dict[str, "Model"] = {}


class _Units(Sequence):
    """The units of a text by their numbers among the distinct ones of many texts."""

    def __init__(self, distinct: list[str], which: np.ndarray):
        self.distinct, self.which = distinct, which

    def __len__(self) -> int:
        return len(self.which)

    def __getitem__(self, k: int) -> str:
        return self.distinct[self.which[k]]


class Model:
    """Pieces, scores and lattices of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [i for i in range(len(self.pieces)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: float(model.get_score(i)) for i in plain}
        self.bytes = {self.pieces[i]: i for i in range(len(self.pieces)) if model.is_byte(i)}
        coded = [bytes([int(p[3:5], 16)]) if p in self.bytes else p.replace(SPACE, " ").encode() for p in self.pieces]
        self.spelling = np.frombuffer(b"".join(coded), np.uint8)
        self.spelling_size = np.array([len(x) for x in coded], np.int64)
        self.spelling_begin = np.cumsum(self.spelling_size) - self.spelling_size
        self.unknown = min(self.scores.values()) - 10.0
        self.unk_id = model.unk_id()
        self.longest = max(map(len, self.ids))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece of this model goes on behind a word")
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(LONG + 1, _BASE)]))
        self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(LONG + 1, np.uint64(pow(int(_BASE), -1, 2**64)))]))
        names = np.array([self._name(p) for p in self.ids if len(p) <= LONG], np.uint64)
        order = np.argsort(names)
        self.names = names[order]
        self.name_score = np.append(np.array([self.scores[p] for p in self.ids if len(p) <= LONG])[order], -np.inf)
        self.name_id = np.append(np.array([i for p, i in self.ids.items() if len(p) <= LONG], np.int32)[order], -1)
        if len(np.unique(self.names)) < len(names):
            raise ValueError("two pieces share a hash")
        self.slots = self._slots()
        self.forget()

    def forget(self) -> None:
        """Start with no remembered unit: numbers of units, and for each number what its best segmentation is."""
        self.known: dict[str, int] = {}
        self.lists: dict[tuple[str, int], list[tuple[float, tuple[int, ...]]]] = {}
        self.total, self.loss = np.zeros(1024), np.zeros(1024)
        self.begin, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(8192, np.int32), 0

    def _slots(self) -> list[np.ndarray]:
        """Places of the names in tables of 2**17 slots, each name in the first table that has its slot free."""
        out, rest = [], np.arange(len(self.names))
        while len(rest):
            slots = np.full(1 << 17, len(self.names), np.int32)
            at = self._slot(self.names[rest], len(out))
            slots[at[::-1]] = rest[::-1]
            out.append(slots)
            rest = rest[slots[at] != rest]
        return out

    @staticmethod
    def _slot(names: np.ndarray, level: int) -> np.ndarray:
        return ((names * np.uint64(0x9FB21C651E98DF25 + 2 * level)) >> np.uint64(47)).astype(np.int64)

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which names are pieces, in any order, and the place of each among the sorted names."""
        padded, none = self._padded, len(self.names)
        at = self.slots[0][self._slot(names, 0)]
        found = padded[at] == names
        there = np.flatnonzero(found)
        all_there, places = [there], [at[there]]
        rest = np.flatnonzero(~found & (at < none))  # a name goes to the next table only if its slot is taken
        for level, slots in enumerate(self.slots[1:], 1):
            own = names[rest]
            at = slots[self._slot(own, level)]
            found = padded[at] == own
            all_there.append(rest[found])
            places.append(at[found])
            rest = rest[~found & (at < none)]
        return np.concatenate(all_there), np.concatenate(places)

    @property
    def _padded(self) -> np.ndarray:
        if not hasattr(self, "_names_padded"):
            # The padding repeats a name that stands elsewhere, so a free slot never seems to hold it.
            self._names_padded = np.append(self.names, np.uint64(0))
        return self._names_padded

    def _remember(self, units: list[str], total: np.ndarray, loss: np.ndarray, count: np.ndarray, flat: np.ndarray) -> None:
        first, last = len(self.known), len(self.known) + len(units)
        while last > len(self.total):
            self.total, self.loss = np.resize(self.total, 2 * len(self.total)), np.resize(self.loss, 2 * len(self.loss))
            self.begin, self.count = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.count, 2 * len(self.count))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.total[first:last], self.loss[first:last], self.count[first:last] = total, loss, count
        self.begin[first:last] = self.used + np.cumsum(count) - count
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.known.update(zip(units, range(first, last), strict=True))

    def _name(self, piece: str) -> int:
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        return int(np.sum(codes * self.power[: len(codes)], dtype=np.uint64))

    def edge_ids(self, piece: str) -> tuple[int, ...]:
        """The ids of a piece, or of the bytes of a character that the model lacks."""
        if piece in self.ids:
            return (self.ids[piece],)
        codes = [self.bytes.get(f"<0x{b:02X}>", self.unk_id) for b in piece.encode("utf-8", "surrogatepass")]
        return tuple(codes) if self.bytes else (self.unk_id,)

    def edges(self, unit: str, end: int) -> Iterator[tuple[int, float]]:
        """(start, score) of each piece that ends at ``end``, the longest first."""
        for start in range(max(0, end - self.longest), end):
            score = self.scores.get(unit[start:end])
            if score is not None:
                yield start, score
            elif start == end - 1:
                yield start, self.unknown

    def forward(self, unit: str) -> list[float]:
        """The best score of each prefix."""
        best = [0.0]
        for end in range(1, len(unit) + 1):
            best.append(max(best[start] + score for start, score in self.edges(unit, end)))
        return best

    def nbest(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations by backward A-star: (score, starts from the last piece to the first).

        Of equal scores the one with the longer last piece comes first, then with the longer piece before it.
        """
        best = self.forward(unit)
        # Partial segmentations in the order of their pieces from the end. Each has a whole one as good as it is worth,
        # so the best n of them hold the n best whole ones, and of equal ones the first.
        queue = [(-best[-1], len(unit), 0.0, None)]
        out = []
        while queue and len(out) < n:
            k = min(range(len(queue)), key=lambda i: queue[i][0])
            worth, at, behind, path = queue.pop(k)
            if at == 0:
                starts = []
                while path is not None:
                    path, start = path
                    starts.append(start)
                out.append((-worth, tuple(reversed(starts))))
                continue
            queue[k:k] = [(-(behind + score + best[start]), start, behind + score, (path, start)) for start, score in self.edges(unit, at)]
            if len(queue) > n - len(out):
                queue = [queue[i] for i in sorted(sorted(range(len(queue)), key=lambda i: queue[i][0])[: n - len(out)])]
        return out

    def ids_of(self, unit: str, starts: tuple[int, ...]) -> tuple[int, ...]:
        cuts = [*reversed(starts), len(unit)]
        return tuple(i for a, b in zip(cuts[:-1], cuts[1:], strict=True) for i in self.edge_ids(unit[a:b]))

    def learn(self, units: set[str]) -> None:
        """Best score, loss of the second choice and ids of units that are not remembered."""
        by_length: dict[int, list[str]] = {}
        for unit in units:
            by_length.setdefault(len(unit), []).append(unit)
        for length, same in by_length.items():
            if length > LONG:
                for unit in same:
                    first = self.nbest(unit, 2)
                    loss = first[0][0] - first[1][0] if len(first) > 1 else np.inf
                    ids = np.array(self.ids_of(unit, first[0][1]), np.int32)
                    self._remember([unit], first[0][0], loss, np.array([len(ids)]), ids)
            else:
                for i in range(0, len(same), BATCH):
                    self._learn(same[i : i + BATCH], length)

    def _learn(self, units: list[str], length: int) -> None:
        """Viterbi passes in both directions over many units of one length."""
        n = len(units)
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length).astype(np.uint64) + np.uint64(1)
        prefix = np.zeros((length + 1, n), np.uint64)
        np.cumsum(codes.T * self.power[:length, None], axis=0, out=prefix[1:])
        edges: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # units, scores and ids of the pieces
        for end in range(1, length + 1):
            for start in range(max(0, end - self.longest), end):
                there, at = self.find((prefix[end] - prefix[start]) * self.inverse[start])
                score, piece = self.name_score[at], self.name_id[at]
                if start == end - 1:
                    lacks = np.ones(n, bool)
                    lacks[there] = False
                    lacks = np.flatnonzero(lacks)
                    there = np.concatenate([there, lacks])
                    score = np.concatenate([score, np.full(len(lacks), self.unknown)])
                    piece = np.concatenate([piece, np.full(len(lacks), -1, np.int32)])
                if len(there):
                    edges[start, end] = there, score, piece
        best, back = np.full((length + 1, n), -np.inf), np.zeros((length + 1, n), np.int32)
        last = np.zeros((length + 1, n), np.int32)  # id of the best piece that ends here, -1 for an unknown character
        best[0] = 0.0
        for (start, end), (there, score, piece) in edges.items():  # by end, then by start: the longest piece wins a tie
            value = best[start][there] + score
            better = value > best[end][there]
            there = there[better]
            best[end][there] = value[better]
            back[end][there] = start
            last[end][there] = piece[better]
        after = np.full((length + 1, n), -np.inf)
        after[length] = 0.0
        for (start, end), (there, score, _) in sorted(edges.items(), key=lambda x: -x[0][1]):
            after[start][there] = np.maximum(after[start][there], score + after[end][there])
        came = np.full((length + 1, n), -1, np.int32)  # start of the best path's piece that ends here
        at, every = np.full(n, length), np.arange(n)
        paths, ids = [], []
        while (at > 0).any():
            start = np.where(at > 0, back[at, every], 0)
            came[at, every] = np.where(at > 0, start, -1)
            paths.append(np.where(at > 0, start, -1))
            ids.append(np.where(at > 0, last[at, every], -2))
            at = start
        second = np.full(n, -np.inf)
        for (start, end), (there, score, _) in edges.items():
            through = best[start][there] + score + after[end][there]
            second[there] = np.maximum(second[there], np.where(came[end][there] == start, -np.inf, through))
        loss = best[length] - second
        path, steps = np.stack(ids[::-1], axis=1), np.stack(paths[::-1], axis=1)
        there = path != -2
        flat, of = path[there], np.repeat(every, there.sum(axis=1))
        lacking = np.flatnonzero(flat == -1)
        if not len(lacking):
            self._remember(units, best[length], loss, there.sum(axis=1), flat)
            return
        # Characters that the model lacks become their bytes.
        chars, which = np.unique(codes[of[lacking], steps[there][lacking]] - np.uint64(1), return_inverse=True)
        coded = [np.array(self.edge_ids(chr(c)), np.int32) for c in chars.tolist()]
        sizes = np.ones(len(flat), np.int64)
        sizes[lacking] = np.array([len(x) for x in coded])[which]
        begins = np.cumsum(sizes) - sizes
        out = np.repeat(flat, sizes)
        for k, own in enumerate(coded):
            out[begins[lacking[which == k]][:, None] + np.arange(len(own))] = own
        self._remember(units, best[length], loss, np.bincount(of, sizes, n).astype(np.int64), out)

    def unit_list(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        if (unit, n) not in self.lists:
            self.lists[unit, n] = [(score, self.ids_of(unit, starts)) for score, starts in self.nbest(unit, n)]
        return self.lists[unit, n]

    def units(self, text: str) -> list[str]:
        """The units of a text, with the space that the model puts in front."""
        return _UNITS.findall((SPACE + text.replace(" ", SPACE)) if text else "")

    def encode(self, text: str, n: int = 1) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of a text: (score, ids)."""
        return self.encode_units(self.units(text), n)

    def encode_units(self, units: list[str], n: int) -> list[tuple[float, list[int]]]:
        total, loss, ids, count = self.best(units)
        return [(score, x.tolist()) for score, x in self.segmentations(units, total, loss, ids, count, n)]

    def segmentations(self, units: Sequence[str], total: float, loss: np.ndarray, ids: np.ndarray, count: np.ndarray, n: int) -> list[tuple[float, np.ndarray]]:
        """The ``n`` best segmentations of units whose ``best`` is known: (score, ids)."""
        cuts = np.cumsum(count)
        return [(score, self.spliced(ids, count, cuts, units, opened, picks, n)) for score, opened, picks in self.choices(units, total, loss, n)]

    def numbers(self, units: list[str], most: int | None = None) -> np.ndarray | None:
        """The numbers of units, which are learned if need be; None if more than ``most`` of them are unknown."""
        out = np.array(list(map(self.known.get, units, repeat(-1))), np.int64)
        lacking = np.flatnonzero(out < 0).tolist()
        if lacking:
            fresh = {units[k] for k in lacking}
            if len(self.known) + len(fresh) > REMEMBERED:
                fresh, lacking = set(units), range(len(units))
                self.forget()
            if most is not None and len(fresh) > most:
                return None
            self.learn(fresh)
            out[lacking] = [self.known[units[k]] for k in lacking]
        return out

    def best(self, units: list[str]) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Score, loss of each unit's second choice, ids and number of ids of each unit, of the best segmentation."""
        totals, losses, ids, counts = [], [], [], []
        for i in range(0, len(units), REMEMBERED // 2):
            at = self.numbers(units[i : i + REMEMBERED // 2])
            count = self.count[at]
            place = np.repeat(self.begin[at] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            totals.append(float(self.total[at].sum()))
            losses.append(self.loss[at])
            ids.append(self.flat[place])
            counts.append(count)
        if not units:
            return 0.0, np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int64)
        return sum(totals), np.concatenate(losses), np.concatenate(ids), np.concatenate(counts)

    def spaced(self, text: str) -> bytes:
        """The units of a text in UTF-8 with a blank between each two."""
        if not text or SPACE in text or "  " in text or text[0] == " ":
            return " ".join(self.units(text)).encode()
        return _SIGN + text.encode().replace(b" ", b" " + _SIGN)

    def best_of(self, texts: list[str]) -> Iterator[tuple[Sequence[str], float, np.ndarray, np.ndarray, np.ndarray]]:
        """The units and ``best`` of several texts, whose arrays are cut out of those of all. Each distinct unit is looked up once."""
        spaced = [self.spaced(x) for x in texts]
        sizes = [x.count(b" ") + 1 if x else 0 for x in spaced]
        joined = b" ".join(filter(None, spaced))
        one = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(joined)])), pa.py_buffer(joined)])
        coded = pc.split_pattern(one, " ").values.dictionary_encode()
        distinct, which = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        del spaced, joined, one, coded
        at = self.numbers(distinct, REMEMBERED) if any(sizes) else None
        if at is None:
            for text in texts:
                units = self.units(text)
                yield units, *self.best(units)
            return
        at = at[which]
        count, loss, total = self.count[at], self.loss[at], self.total[at]
        cuts = np.cumsum(count)
        ids = self.flat[np.repeat(self.begin[at] - (cuts - count), count) + np.arange(count.sum())]
        first = last = begin = 0
        for size in sizes:
            last += size
            end = int(cuts[last - 1]) if last else 0
            yield _Units(distinct, which[first:last]), float(total[first:last].sum()), loss[first:last], ids[begin:end], count[first:last]
            first, begin = last, end

    def choices(self, units: Sequence[str], total: float, loss: np.ndarray, n: int) -> list[tuple[float, list[int], tuple[int, ...]]]:
        """The ``n`` best segmentations: score, the units that were opened, and which of its own each takes.

        A-star over the opened units: what the others and all choices not yet made score at best is known exactly.
        """
        m = min(n - 1, len(units))
        if not m:
            return [(total, [], ())]
        opened = np.sort(np.argsort(loss, kind="stable")[:m] if len(loss) < 64 else np.argpartition(loss, m - 1)[:m]).tolist()
        lists = [self.unit_list(units[k], n) for k in opened]
        queue, seen, out = [(-total, (0,) * m)], {(0,) * m}, []
        while queue and len(out) < n:
            worth, picks = heapq.heappop(queue)
            out.append((-worth, opened, picks))
            for i, pick in enumerate(picks):
                following = (*picks[:i], pick + 1, *picks[i + 1 :])
                if pick + 1 < len(lists[i]) and following not in seen:
                    seen.add(following)
                    heapq.heappush(queue, (worth + lists[i][pick][0] - lists[i][pick + 1][0], following))
        return out

    def spliced(self, ids: np.ndarray, count: np.ndarray, cuts: np.ndarray, units: Sequence[str], opened: list[int], picks: tuple[int, ...], n: int) -> np.ndarray:
        """The ids of a segmentation: those of the best one but for the units that take another choice."""
        if not any(picks):
            return ids
        out, at = [], 0
        for k, pick in zip(opened, picks, strict=True):
            if pick:
                out += [ids[at : cuts[k] - count[k]], np.array(self.unit_list(units[k], n)[pick][1], np.int32)]
                at = cuts[k]
        return np.concatenate([*out, ids[at:]])

    def spelled(self, segmentations: list[np.ndarray]) -> list[bytes]:
        """The text of each segmentation in UTF-8, from all its ids: byte pieces become characters again, and the space in front goes."""
        ids = np.concatenate(segmentations)
        size = self.spelling_size[ids]
        cuts = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(self.spelling_begin[ids] - cuts[:-1], size)
        place += np.arange(cuts[-1])
        coded = self.spelling[place].tobytes()
        ends = cuts[np.cumsum([0, *map(len, segmentations)])].tolist()
        return [coded[a:b].replace(_SIGN, b" ")[1:] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        return self.spelled([np.array(ids, np.int32)])[0].decode("utf-8", "replace")


def model(path: str | None = None) -> Model:
    """One model for each worker and file; the installed 32k pieces if none is named."""
    import public_tokenizers

    path = str(path or public_tokenizers.path("piece_bpe_32k.model"))
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def _together(texts: list[str]) -> Iterator[tuple[int, int]]:
    """(first, last) of texts that hold ``TOGETHER`` characters or so."""
    first, n = 0, 0
    for k, text in enumerate(texts):
        n += len(text)
        if n >= TOGETHER:
            yield first, k + 1
            first, n = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


class _Part:
    """Segmentations of some texts on the way into Arrow."""

    def __init__(self, with_ids: bool, best_apart: bool, with_decoded: bool):
        self.with_ids, self.best_apart, self.with_decoded = with_ids, best_apart, with_decoded
        self.of_text, self.scores, self.round_trips, self.crcs, self.ids, self.decoded = [], [], [], [], [], []
        self.n_ids = 0

    def add(self, text: str, scores: list[float], ids: list[np.ndarray], spelled: list[bytes]) -> None:
        wanted = text.replace(SPACE, " ").encode()
        self.of_text.append(len(scores))
        self.scores += scores
        self.round_trips += [x == wanted for x in spelled]
        self.crcs += [zlib.crc32(x.astype("<u4", copy=False)) for x in ids]
        self.ids += ids
        self.n_ids += sum(map(len, ids))
        if self.with_decoded:
            self.decoded.append(spelled[0].decode("utf-8", "replace"))

    @property
    def full(self) -> bool:
        return self.n_ids >= PART

    def rows(self, doc_id: pa.Array) -> pa.RecordBatch:
        """One row for each text."""
        cuts = np.cumsum([0, *self.of_text])
        best, offsets = cuts[:-1], pa.array(cuts, pa.int32())
        sizes = np.array([len(x) for x in self.ids], np.int64)
        one = {
            "score": pa.array(self.scores, pa.float64()), "n_pieces": pa.array(sizes), "ids_crc32": pa.array(self.crcs, pa.int64()),
            "round_trip": pa.array(self.round_trips, pa.bool_()),
        }
        out = {"doc_id": doc_id, **{name: one[name].take(pa.array(best)) for name in ("n_pieces", "ids_crc32", "round_trip")}}
        out["scores"] = pa.ListArray.from_arrays(offsets, one["score"])
        if self.with_ids:
            one["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(self.ids)))
        out["segmentations"] = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(list(one.values()), list(one)))
        names = ["doc_id", "n_pieces", "ids_crc32", "scores", "round_trip", "segmentations"]
        if self.with_ids and self.best_apart:
            out["ids"] = one["ids"].take(pa.array(best))
            names.append("ids")
        if self.with_decoded:
            out["decoded"] = pa.array(self.decoded, pa.string())
            names.append("decoded")
        return pa.RecordBatch.from_arrays([out[x] for x in names], names)


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, path: str | None = None,
    with_ids: bool = True, with_decoded: bool = False, best_apart: bool = True,
) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, scores, round_trip and segmentations, and the ids and the decoded text if asked for.

    ``segmentations`` are the ``n`` best, best first: the score of each, its number of pieces, the CRC-32 of its ids as
    little-endian 32-bit numbers, whether its own ids, all of them decoded, give the text, and the ids if asked for. The
    columns beside them are those of the best one, its ids only if ``best_apart``; ``scores`` are those of all. A text that holds the model's own space sign decodes
    with plain spaces in its place. Fewer segmentations come if a text has fewer; a null or empty text has one, of no
    pieces, with score 0. Equal rows stay. An empty table gives none. Only the id and the text are read.
    """

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = model(path)
        for batch in batches:
            texts = [x or "" for x in batch["text"].to_pylist()]
            for first, last in _together(texts):
                part, at = _Part(with_ids, best_apart, with_decoded), first
                for k, (units, *best) in enumerate(lattice.best_of(texts[first:last]), first):
                    found = lattice.segmentations(units, *best, n)
                    ids = [x for _, x in found]
                    part.add(texts[k], [score for score, _ in found], ids, lattice.spelled(ids))
                    if part.full or k + 1 == last:
                        yield part.rows(batch["doc_id"].slice(at, k + 1 - at))
                        part, at = _Part(with_ids, best_apart, with_decoded), k + 1

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    one = "score:double,n_pieces:long,ids_crc32:long,round_trip:boolean" + ",ids:array<int>" * with_ids
    more = ", ids array<int>" * (with_ids and best_apart) + ", decoded string" * with_decoded
    return rows.mapInArrow(segment, f"doc_id long, n_pieces long, ids_crc32 long, scores array<double>, round_trip boolean, segmentations array<struct<{one}>>{more}")
