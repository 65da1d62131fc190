"""Adaptive context-mixing range coder for token ids, many blocks at a time.

An id takes one mixed decision and at most one table look-up. The decision: is it the
id that the contexts foretell? The last id (order 1) and the last two (order 2) each
remember an id that followed them and an adaptive probability that it follows again;
the surer one names the candidate. Both probabilities and one kept for all contexts
(order 0, by whether the two agree and what the last decision was) are mixed in the
logistic domain by weights that learn from each error. An id that was not foretold is
coded by its frequency after the last id, where that is a frequent one, else by its
frequency among all ids; both steps drive one range coder (rANS) of 62 bits of state.

Every block starts from the same state, so blocks decode independently; numpy steps
through all blocks of a batch together, one id of each at a time. All arithmetic is on
integers, so a block decodes alike on any machine.
"""

from __future__ import annotations

import numpy as np

SLOT_BITS = 11
RATE, WEIGHT_SHIFT = 4, 16
START_WEIGHTS = (22000, 26000, 30000)
#: A remembered id's probability at first; below which another takes its place.
FIRST, LEAST = 16000, 6000
_p = (np.arange(4096) + 0.5) / 4096
STRETCH = np.round(np.log(_p / (1 - _p)) * 256).astype(np.int32)
SQUASH = np.clip(np.round(65536 / (1 + np.exp(-(np.arange(4096) - 2048) / 256))), 48, 65488).astype(np.int32)
#: What an id adds to the hash of a context: order 1; order 2 as the last, as the one before.
HASHES = (81007, 62533, 52711)
#: Bits of the decision, of a table of frequencies, and of a rare id's number at once; the first two
#: together fit the coder's state, which holds at least ``LOW``.
FLAG, SCALE, RAW = 16, 14, 16
LOW, TOP = 1 << FLAG + SCALE, FLAG + SCALE + 32
#: Ids after which frequencies are told apart, at most; and entries of all their counts together.
BRANCHES, ENTRIES = 256, 4_000_000
#: Steps whose table entries are looked up together.
STRIDE = 16


def branches(symbols: int) -> int:
    """How many of the most frequent ids have frequencies of their own after them."""
    return min(BRANCHES, symbols, ENTRIES // max(1, symbols))


def by_rank(symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The symbols, most frequent first."""
    return symbols[np.lexsort((symbols, -counts))]


def scaled(counts: np.ndarray, total: int) -> np.ndarray:
    """Frequencies of 1 << SCALE in all: first of what is not listed, then of each count; 0 where it is too rare."""
    full, total = 1 << SCALE, max(total, 1)
    out = np.concatenate([[0], counts * full // total])
    out[0] = max(1, int(total - counts[out[1:] > 0].sum()) * full // total)
    out[len(out) - 1 - out[::-1].argmax()] += full - out.sum()  # at most one too many
    return out


class Tree:
    """Frequencies of ids: the root's among all, and a branch's after each frequent id.

    Rows of (last, symbol, freq); the root's ``last`` is -1 and it lists every symbol, most
    frequent first, be its frequency 0; symbol -1 stands for all that a branch does not list.
    """

    def __init__(self, last: np.ndarray, symbol: np.ndarray, freq: np.ndarray):
        self.rows = last, symbol, freq
        listed = (last < 0) & (symbol >= 0)
        self.symbols = np.concatenate([[0], symbol[listed]]).astype(np.int64)  # numbered from 1
        n = len(self.symbols)
        self.rank = np.zeros(int(self.symbols.max()) + 1, np.int64)
        self.rank[self.symbols[1:]] = np.arange(1, n)
        self.low = min(RAW, n.bit_length())  # bits of a number, and those above
        self.high = n.bit_length() - self.low
        kept = freq > 0
        last, symbol, freq = last[kept], symbol[kept], freq[kept].astype(np.int64)
        branch, which = np.unique(np.where(last < 0, 0, self.rank[last]), return_inverse=True)
        order = np.argsort(which, kind="stable")
        which, symbol, freq = which[order], symbol[order], freq[order]
        self.branch = np.zeros(n, np.int64)  # of the last id; none at a block's start
        self.branch[branch] = np.arange(len(branch))
        number = np.where(symbol < 0, 0, self.rank[symbol])
        upto = np.cumsum(freq)
        if (upto[-1] != len(branch) << SCALE) or (np.bincount(which, freq) != 1 << SCALE).any():
            raise ValueError("frequencies do not fill their scale")
        # number, frequency and start of each entry; the last takes no room: an id that was foretold
        self.packed = np.append(number << 32 | freq << 16 | upto - freq - (which << SCALE), 1 << 32 | 1 << SCALE + 16)
        self.first = np.searchsorted(which, np.arange(len(branch)))
        self.slots = np.repeat((np.arange(len(freq)) - self.first[which]).astype(np.uint16), freq)  # from a branch's first
        self.entry = np.zeros((len(branch), n), np.int32)  # where an id is not listed: the rest's
        self.entry[which[number == 0]] = np.flatnonzero(number == 0)[:, None]
        self.entry[which, number] = np.arange(len(freq))
        self.entry = self.entry.reshape(-1)
        rank = np.arange(n)
        # a slot that an id has taken; those beyond 16 bits are not foretold
        self.fresh = (np.where(rank < 1 << 16, rank, 0) << 16 | FIRST).astype(np.uint32).view(np.int32)

    @classmethod
    def of_counts(cls, symbols: np.ndarray, counts: np.ndarray, pairs: tuple | None = None) -> Tree:
        """From the count of each symbol and, as arrays (last, symbol, count), of what follows some of them."""
        ranked = by_rank(symbols, counts)
        at = np.searchsorted(symbols, ranked, sorter=(by := np.argsort(symbols)))
        counts = counts[by][at]
        parts = [(-1, np.concatenate([[-1], ranked]), scaled(counts, int(counts.sum())))]
        if pairs is not None:
            order = np.lexsort((pairs[1], pairs[0]))
            last, symbol, count, total = (np.asarray(x)[order] for x in pairs)
            cuts = np.flatnonzero(np.diff(last)) + 1
            for l, s, c, t in zip(*(np.split(x, cuts) for x in (last, symbol, count, total))):
                if len(l):
                    parts.append((l[0], np.concatenate([[-1], s]), scaled(c, int(t[0]))))
        return cls(np.concatenate([np.full(len(s), l, np.int64) for l, s, _ in parts]),
                   np.concatenate([s for _, s, _ in parts]).astype(np.int64), np.concatenate([f for *_, f in parts]))


class _Model:
    """What the lanes have learned, a lane for each block."""

    def __init__(self, tree: Tree, lanes: int):
        self.fresh = tree.fresh
        lane = np.arange(lanes)
        self.table = np.zeros(2 * lanes << SLOT_BITS, np.int32)  # the id foretold, and its probability
        self.base = np.stack([lane << SLOT_BITS, lanes + lane << SLOT_BITS])
        self.flags = np.full(4 * lanes, 4096, np.int32)
        self.flag_base, self.past = 4 * lane, 4 * lane
        self.weight = np.repeat(np.array(START_WEIGHTS, np.int32)[:, None], lanes, 1)

    def slots(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Where the contexts of the last id and of the last two are; a step, or several below each other."""
        hashed = np.empty((*last.shape[:-1], 2, last.shape[-1]), np.int32)
        np.multiply(last, HASHES[0], out=hashed[..., 0, :])
        np.multiply(last, HASHES[1], out=hashed[..., 1, :])
        hashed[..., 1, :] += before * HASHES[2]
        hashed >>= 4
        hashed &= (1 << SLOT_BITS) - 1
        return self.base[:, :last.shape[-1]] + hashed

    def predict(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidate and its probability, of 1 << FLAG."""
        n = slot.shape[1]
        told = self.table.take(slot)
        p = told & 65535
        told >>= 16
        told &= 65535
        second = p[1] >= p[0]
        candidate = told[0] ^ told[1]
        agree = candidate == 0
        candidate &= -second.astype(np.int32)  # all bits where the second is surer: a choice without a branch
        candidate ^= told[0]
        at = self.past[:n] + agree
        probabilities = np.empty((3, n), np.int32)
        self.flags.take(at, out=probabilities[0], mode="clip")
        probabilities[1:] = p
        index = probabilities.astype(np.int64)
        index >>= 4
        s = STRETCH.take(index, mode="clip")
        second |= agree
        s[2] *= second
        second ^= ~agree
        s[1] *= second
        dot = self.weight[:, :n] * s
        dot = dot[0] + dot[1] + dot[2]  # a wrap, were there one, is the same on both sides
        dot >>= 16
        dot += 2048
        mixed = SQUASH.take(dot.astype(np.int64), mode="clip")
        self.seen = slot, told, probabilities, at, s, mixed
        return candidate, mixed

    def learn(self, hit: np.ndarray, number: np.ndarray) -> None:
        slot, told, p, at, s, mixed = self.seen
        n = len(hit)
        goal = np.empty((3, n), np.int32)
        goal[0] = hit
        np.equal(told, number, out=goal[1:], casting="unsafe")
        goal *= 65535
        s *= goal[0] - mixed
        s >>= WEIGHT_SHIFT
        self.weight[:, :n] += s
        goal -= p
        goal >>= RATE
        p += goal
        self.flags[at] = p[0]
        self.past = self.flag_base[:n] + 2 * hit
        told <<= 16
        told |= p[1:]
        change = told ^ self.fresh.take(number)
        change &= -(p[1:] < LEAST).astype(np.int32)
        told ^= change
        self.table[slot] = told


def _lanes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The blocks, longest first, and how many are still going at each step."""
    order = np.argsort(-counts, kind="stable")
    steps = int(counts.max())
    return order, len(counts) - np.searchsorted(np.sort(counts), np.arange(steps), side="right")


def encode_blocks(tree: Tree, blocks: list[np.ndarray]) -> list[bytes]:
    """The payload of each block of ids."""
    if not blocks:
        return []
    n, counts = len(blocks), np.array([len(b) for b in blocks])
    order, going = _lanes(counts)
    steps = len(going)
    ids = np.zeros((steps + 2, n), np.int32)  # two rows before the first id
    for lane, k in enumerate(order):
        ids[2:counts[k] + 2, lane] = tree.rank[blocks[k]]
    chance, hits = np.zeros((steps, n), np.uint16), np.zeros((steps, n), bool)
    model = _Model(tree, n)
    for t in range(steps):
        a = int(going[t])
        if t % STRIDE == 0:
            to = min(t + STRIDE, steps)
            slots = model.slots(ids[t + 1:to + 1], ids[t:to])
        number = ids[t + 2, :a]
        candidate, mixed = model.predict(slots[t % STRIDE, :, :a])
        hit = np.equal(candidate, number, out=hits[t, :a])
        chance[t, :a] = mixed
        model.learn(hit, number)
    del model
    # the coder's last step is the decoder's first
    width = steps // 4 + 8 * STRIDE
    out = np.zeros(n * width, np.uint32)  # words of a lane, the last ones first
    lane, place = np.arange(n), np.arange(n) * width
    x = np.full(n, LOW, np.int64)

    def emit(at: np.ndarray) -> None:
        if len(at):
            to = place.take(at)
            some = x.take(at)
            out[to] = some & 0xFFFFFFFF
            some >>= 32
            x[at] = some
            to += 1
            place[at] = to

    def put(at: np.ndarray, freq: np.ndarray, start: np.ndarray, bits: int) -> None:
        emit(at[x.take(at) >= freq << TOP - bits])
        some = x.take(at)
        q = some // freq
        x[at] = (q << bits) + (some - q * freq) + start

    foretold = len(tree.packed) - 1
    for end in range(steps, 0, -STRIDE):
        begin = max(0, end - STRIDE)
        if int((place - lane * width).max()) + 4 * STRIDE > width:
            wider = np.zeros((n, 2 * width + 4 * STRIDE), np.uint32)
            wider[:, :width] = out.reshape(n, width)
            place += lane * (wider.shape[1] - width)
            out, width = wider.reshape(-1), wider.shape[1]
        hit = hits[begin:end]
        entry = tree.branch.take(ids[begin + 1:end + 1])
        entry *= len(tree.symbols)
        entry += ids[begin + 2:end + 2]
        entry = tree.entry.take(entry)
        np.copyto(entry, foretold, where=hit)
        start = tree.packed.take(entry)
        freq = start >> 16
        start &= 65535
        rare = freq < 65536
        freq &= 65535
        skip = chance[begin:end].astype(np.int64)
        part = np.where(hit, skip, (1 << FLAG) - skip)
        np.copyto(skip, 0, where=hit)
        most = freq * part
        most <<= 32
        for t in range(end - begin - 1, -1, -1):
            a = int(going[begin + t])
            at = rare[t, :a].nonzero()[0]
            if len(at):
                here = ids[begin + t + 2].take(at)
                root = tree.packed.take(tree.entry.take(here))
                unlisted = root >> 32 == 0
                raw, whole = at[unlisted], here[unlisted].astype(np.int64)
                put(raw, np.int64(1), whole & (1 << tree.low) - 1, tree.low)
                if tree.high:
                    put(raw, np.int64(1), whole >> tree.low, tree.high)
                again = tree.branch.take(ids[begin + t + 1].take(at)) > 0
                put(at[again], root[again] >> 16 & 65535, root[again] & 65535, SCALE)
            y = x[:a]
            emit((y >= most[t, :a]).nonzero()[0])
            for f, s, bits in ((freq[t, :a], start[t, :a], SCALE), (part[t, :a], skip[t, :a], FLAG)):
                q = (y.view(np.uint64) // f.view(np.uint64)).view(np.int64)
                f *= q
                y -= f
                y += s
                q <<= bits
                y += q
    payloads = [b""] * n
    for k, (b, to) in enumerate(zip(order, place.tolist())):
        state = int(x[k])
        words = np.append(out[k * width:to], np.array([state & 0xFFFFFFFF, state >> 32], np.uint32))
        payloads[b] = words[::-1].astype("<u4").tobytes() if counts[b] else b""
    return payloads


def decode_blocks(tree: Tree, payloads: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """The ids of each block."""
    if not payloads:
        return []
    n, sizes = len(payloads), np.array(counts, np.int64)
    order, going = _lanes(sizes)
    steps = len(going)
    words = np.frombuffer(b"".join(payloads[k] for k in order) + bytes(8), "<u4").astype(np.int64)
    held = np.array([len(payloads[k]) // 4 for k in order])
    place = np.cumsum(held) - held
    x = words.take(place, mode="clip") << 32 | words.take(place + 1, mode="clip")
    place += 2
    ids = np.zeros((steps + 2, n), np.int32)
    model = _Model(tree, n)
    packed, slots, foretold = tree.packed, tree.slots, tree.packed[-1]

    def refill(at: np.ndarray) -> None:
        to = place.take(at)
        some = x.take(at)
        some <<= 32
        some |= words.take(to, mode="clip")
        x[at] = some
        to += 1
        place[at] = to

    def raw(at: np.ndarray, bits: int) -> np.ndarray:
        some = x.take(at)
        rest = some >> bits
        x[at] = rest
        refill(at[rest < LOW])
        return some & (1 << bits) - 1

    def listed(y: np.ndarray, branch: np.ndarray, hit: np.ndarray) -> np.ndarray:
        slot = y & (1 << SCALE) - 1
        entry = tree.first.take(branch)
        branch <<= SCALE
        branch |= slot
        entry += slots.take(branch)
        found = packed.take(entry)
        np.copyto(found, foretold, where=hit)
        y >>= SCALE
        slot -= found & 65535
        found >>= 16
        y *= found & 65535
        y += slot
        found >>= 16
        return found

    for t in range(steps):
        a = int(going[t])
        candidate, mixed = model.predict(model.slots(ids[t + 1, :a], ids[t, :a]))
        y, start = x[:a], mixed.astype(np.int64)
        slot = y & 65535
        hit = slot < start
        y >>= FLAG
        y *= np.where(hit, start, (1 << FLAG) - start)
        np.copyto(start, 0, where=hit)
        slot -= start
        y += slot
        branch = tree.branch.take(ids[t + 1, :a])
        number = listed(y, branch, hit).astype(np.int32)
        refill((y < LOW).nonzero()[0])
        rare = (number == 0).nonzero()[0]
        if len(rare):
            again = rare[tree.branch.take(ids[t + 1].take(rare)) > 0]
            some = y.take(again)
            number[again] = listed(some, np.zeros(len(again), np.int64), np.zeros(len(again), bool))
            y[again] = some
            refill(again[some < LOW])
            rare = rare[number.take(rare) == 0]
            if len(rare):
                high = raw(rare, tree.high) if tree.high else 0
                number[rare] = high << tree.low | raw(rare, tree.low)
        np.copyto(number, candidate, where=hit)
        ids[t + 2, :a] = number
        model.learn(hit, number)
    del model
    symbols, out = tree.symbols.astype(np.uint32), [None] * n
    for lane, k in enumerate(order):
        out[k] = symbols.take(ids[2:sizes[k] + 2, lane])
    return out
