"""Adaptive context-mixing range coder for token ids, many blocks in lockstep.

A block of up to ``BLOCK`` ids is coded on its own: its models start fresh and its bytes end with it. Three
orders predict the next id: order 2 the id last seen behind the same two ids, order 1 the id last seen
behind the same id (each with a confidence of 1 to 4), order 0 the block's frequencies of the ids that neither
of them told. An adaptive weight per joint confidence mixes them: it shares the coder's range among "order 2 is
right", "order 1 is right" and "order 0 decides".

A block's bytes are 16-bit digits in three parts. The head lists the ids of order 0 ascending (low bits plain, high bits
as gaps in a bitmap) and their frequencies (in unary). Then come two range coders' digits, first those of
what the mixture chose, then those of the ids that order 0 decided. The latter need no context, so they are
read first, by themselves.

Blocks of one frame are the lanes of numpy arrays, and one step codes one id of each of them. The coders' state are
whole numbers below 2**50 in float64. They and the weights meet only single additions, multiplications,
divisions and roundings, which IEEE 754 defines to the bit, so decoding repeats encoding exactly.
"""

from __future__ import annotations

import numpy as np

BLOCK = 2048
# Slots of the order-2 table as a power of 2.
PAIR_BITS = 10
# Ids are below 2**16: so many of their bits are written plainly, and how many values the others have.
LOW_BITS, HIGHS = 8, 256
DIGIT, LOW, TOP = 65536.0, 2.0**32, 2.0**48
WIDEN = np.array([1, DIGIT])
# Confidence 0 for "no prediction", or 1 to 4: first guess at how often it is right.
GUESS = np.array([0.001, 0.25, 0.45, 0.67, 0.85])
# Joint confidences: of order 2, of order 1, and whether both predict the same id.
STATE_BITS = 7
# A weight moves by 1 / 16 to one of these, so it never reaches 0 or 1.
RARE, SURE = 0.002, 0.98
KEPT = np.float32(1 - 1 / 16)
# By what came (0 order 2, 1 order 1, 2 order 0): order 1 is not tested where order 2 is right.
MOVED2 = np.array([SURE / 16, RARE / 16, RARE / 16], np.float32)
KEPT1 = np.array([1, KEPT, KEPT], np.float32)
MOVED1 = np.array([0, SURE / 16, RARE / 16], np.float32)
# Frequencies are below 2**SIZE_BITS, and a place in a block's list of order 0 stands above its frequency.
SIZE_BITS = 12
SIZE = (1 << SIZE_BITS) - 1


class Models:
    """Predictions and weights of every lane. An entry of a table is 8 * number + confidence."""

    def __init__(self, lanes: int, most: int) -> None:
        lane = np.arange(lanes)
        self.lanes = lanes
        self.pair_base, self.one_base, self.state_base = lane << PAIR_BITS, lane * (most + 1), lane << STATE_BITS
        self.pairs = np.zeros(lanes << PAIR_BITS, np.int16)
        self.ones = np.zeros(lanes * (most + 1), np.int16)
        state = np.arange(1 << STATE_BITS)
        self.right2 = np.tile(GUESS[np.minimum(state >> 4, 4)], lanes).astype(np.float32)
        self.right1 = np.tile(GUESS[np.minimum(state >> 1 & 7, 4)] / 2, lanes).astype(np.float32)
        self.last1 = np.zeros(lanes, np.int16)
        self.last2 = np.zeros(lanes, np.int16)
        # Rows: where the shares of the range begin and end, and the number that each share stands for.
        self.ends = np.zeros((4, lanes))
        self.ends[3] = TOP
        self.told = np.zeros((3, lanes), np.int16)
        self.rows = lane + np.arange(3)[:, None] * lanes

    def predict(self, n: int) -> None:
        """The predictions of the first lanes, and where in the range order 2 and order 1 end."""
        last1 = self.last1[:n]
        # Products wrap around.
        mixed = last1 * np.int16(2531)
        mixed += self.last2[:n]
        mixed &= (1 << PAIR_BITS) - 1
        self.at2 = mixed + self.pair_base[:n]
        self.at1 = last1 + self.one_base[:n]
        two, one = self.pairs.take(self.at2, mode="clip"), self.ones.take(self.at1, mode="clip")
        guess2, guess1 = np.right_shift(two, 3, out=self.told[0, :n]), np.right_shift(one, 3, out=self.told[1, :n])
        two &= 7
        one &= 7
        state = two << 3
        state += one
        state += state
        state += guess2 == guess1
        self.sure2, self.sure1, self.state = two, one, state + self.state_base[:n]
        self.weight2 = self.right2.take(self.state, mode="clip")
        self.weight1 = self.right1.take(self.state, mode="clip")
        span, end2, end1 = self.ends[3, :n], self.ends[1, :n], self.ends[2, :n]
        np.multiply(span, self.weight2, out=end2)
        np.floor(end2, out=end2)
        np.subtract(span, end2, out=end1)
        end1 *= self.weight1
        np.floor(end1, out=end1)
        end1 += end2

    def narrow(self, n: int, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Narrow the range to a share (0, 1 or 2 for order 2, 1, 0); (its begin, its place among the rows)."""
        place = share * self.lanes
        place += self.rows[0, :n]
        ends = self.ends.ravel()
        low = ends.take(place, mode="clip")
        high = ends.take(place + self.lanes, mode="clip")
        np.subtract(high, low, out=self.ends[3, :n])
        return low, place

    def learn(self, n: int, number: np.ndarray, share: np.ndarray) -> None:
        """Update everything by the numbers that came and the shares that told them."""
        fresh = number << 3
        fresh += 1
        # A right guess gains confidence up to 4, a wrong one makes way.
        for table, at, sure, guess in (
            (self.pairs, self.at2, self.sure2, self.told[0, :n]),
            (self.ones, self.at1, self.sure1, self.told[1, :n]),
        ):
            np.minimum(sure, 3, out=sure)
            sure *= guess == number
            sure += fresh
            table[at] = sure
        self.weight2 *= KEPT
        self.weight2 += MOVED2.take(share, mode="clip")
        self.right2[self.state] = self.weight2
        self.weight1 *= KEPT1.take(share, mode="clip")
        self.weight1 += MOVED1.take(share, mode="clip")
        self.right1[self.state] = self.weight1
        np.multiply(self.last1[:n], 67, out=self.last2[:n])
        self.last1[:n] = number


def active(lengths: np.ndarray) -> list[int]:
    """For each step, how many of the lanes, longest first, have an id left."""
    return np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left").tolist()


class Writer:
    """Digits of many range coders."""

    def __init__(self, lanes: int, steps: int) -> None:
        self.low = np.zeros(lanes)
        # A digit is written at the end of a lane's digits in any case and counts if the range became narrow.
        self.at = np.arange(lanes) * (steps + 3)
        self.begin = self.at.copy()
        self.digits = np.zeros(lanes * (steps + 3), np.int32)

    def shift(self, n: int, span: np.ndarray) -> None:
        """Write a digit of the lanes whose range became narrow."""
        low = self.low[:n]
        narrow = (span <= LOW).astype(np.int64)
        widen = WIDEN.take(narrow, mode="clip")
        digit = low * (1 / LOW)
        np.floor(digit, out=digit)
        at = self.at[:n]
        self.digits[at] = digit
        at += narrow
        digit *= LOW
        digit *= narrow
        low -= digit
        low *= widen
        span *= widen

    def shift_few(self, n: int, span: np.ndarray) -> None:
        """The same where it concerns few lanes."""
        few = (span <= LOW).nonzero()[0]
        low = self.low[few]
        digit = np.floor(low * (1 / LOW))
        at = self.at[few]
        self.digits[at] = digit
        self.at[few] = at + 1
        low -= digit * LOW
        low *= DIGIT
        self.low[few] = low
        span[few] *= DIGIT

    def end(self) -> tuple[np.ndarray, np.ndarray]:
        """All digits, a row per lane, and how many of each row count."""
        rest = np.ceil(self.low / DIGIT).astype(np.int64)
        for digit in (rest >> 16, rest & 0xFFFF):
            self.digits[self.at] = digit
            self.at += 1
        used = self.at - self.begin
        out = self.digits.reshape(len(self.low), -1)[:, : int(used.max())].copy()
        out[np.arange(out.shape[1]) >= used[:, None]] = 0
        while (carry := out >> 16).any():
            out &= 0xFFFF
            out[:, :-1] += carry[:, 1:]
        return out, used


class Reader:
    """What many range coders still have to read, behind the first three digits of each."""

    def __init__(self, flat: np.ndarray, at: np.ndarray) -> None:
        self.flat, self.at = flat, at + 3
        self.code = (flat[at] * DIGIT + flat[at + 1]) * DIGIT + flat[at + 2]

    def shift(self, n: int, span: np.ndarray) -> None:
        """Read a digit for the lanes whose range became narrow."""
        narrow = (span <= LOW).astype(np.int64)
        widen = WIDEN.take(narrow, mode="clip")
        at, code = self.at[:n], self.code[:n]
        digit = self.flat.take(at, mode="clip")
        digit *= narrow
        at += narrow
        code *= widen
        code += digit
        span *= widen

    def shift_few(self, n: int, span: np.ndarray) -> None:
        """The same where it concerns few lanes."""
        few = (span <= LOW).nonzero()[0]
        at = self.at[few]
        self.code[few] = self.code[few] * DIGIT + self.flat[at]
        self.at[few] = at + 1
        span[few] *= DIGIT


def head(ids: np.ndarray, counts: np.ndarray, before: np.ndarray) -> bytes:
    """Bytes that tell the ascending ids and how often order 0 decides for each; whole digits."""
    bits = np.zeros(len(ids) + HIGHS + int(before[-1] + counts[-1]), np.uint8)
    bits[(ids >> LOW_BITS) + np.arange(len(ids))] = 1
    bits[before + (len(ids) + HIGHS)] = 1
    raw = ids.astype(np.uint8).tobytes() + np.packbits(bits).tobytes()
    return raw + b"\0" * (len(raw) % 2)


def head_digits(n_ids: int, total: int) -> int:
    """How many digits a head takes."""
    return (n_ids + (n_ids + HIGHS + total + 7) // 8 + 1) // 2


def behead(raw: bytes, n_ids: int, total: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(ids, how many decisions of order 0 come before each); None if they contradict themselves."""
    ones = np.unpackbits(np.frombuffer(raw, np.uint8, offset=n_ids), count=n_ids + HIGHS + total).nonzero()[0]
    if len(ones) != 2 * n_ids or not ones[n_ids - 1] < n_ids + HIGHS == ones[n_ids]:
        return None
    ids = ((ones[:n_ids] - np.arange(n_ids)) << LOW_BITS) + np.frombuffer(raw, np.uint8, n_ids)
    return ids, ones[n_ids:] - (n_ids + HIGHS)


def encode(lanes: list[np.ndarray]) -> tuple[bytes, np.ndarray]:
    """(bytes of all lanes, 16-bit digits of each). Lanes come longest first."""
    count = len(lanes)
    lengths = np.array([len(x) for x in lanes])
    steps = int(lengths[0])
    numbers, names = np.zeros((count, steps), np.int16), []
    # An id's number is its rank in the block, from 1.
    rank = np.zeros(HIGHS << LOW_BITS, np.int16)
    for i, x in enumerate(lanes):
        ids = np.sort(x.astype(np.uint16), kind="stable")
        ids = np.concatenate((ids[:1], ids[1:][ids[1:] != ids[:-1]])).astype(np.int64)
        names.append(ids)
        rank[ids] = np.arange(1, len(ids) + 1)
        rank.take(x, out=numbers[i, : len(x)], mode="clip")
    most = max(len(x) for x in names)
    shares = np.zeros((steps, count), np.int8)
    columns = np.ascontiguousarray(numbers.T)
    model, mixed = Models(count, most), Writer(count, steps)
    for t, n in enumerate(active(lengths)):
        number = columns[t, :n]
        model.predict(n)
        # 0 if order 2 is right, else 1 if order 1 is, else 2.
        share = np.subtract(2, model.told[1, :n] == number, out=shares[t, :n])
        share *= model.told[0, :n] != number
        share = share.astype(np.int64)
        low, _ = model.narrow(n, share)
        mixed.low[:n] += low
        mixed.shift_few(n, model.ends[3, :n])
        model.learn(n, number, share)
    chosen, of_chosen = mixed.end()
    rests = shares == 2
    rests = np.ascontiguousarray(rests.T)
    totals = rests.sum(1)
    order = np.argsort(-totals, kind="stable")
    slots, heads = np.zeros((count, int(totals.max())), np.int32), [None] * count
    for k, i in enumerate(order.tolist()):
        decided = numbers[i][rests[i]]
        counts = np.bincount(decided, minlength=len(names[i]) + 1)
        before = np.cumsum(counts) - counts
        heads[i] = head(names[i], counts[1:], before[1:])
        slots[k, : len(decided)] = ((before << SIZE_BITS) | counts).take(decided)
    slots = np.ascontiguousarray(slots.T)
    plain, spans = Writer(count, slots.shape[0]), np.full(count, TOP)
    part_of = 1 / totals[order]
    for t, n in enumerate(active(totals[order])):
        slot, span = slots[t, :n], spans[:n]
        part = span * part_of[:n]
        np.floor(part, out=part)
        np.multiply(part, slot & SIZE, out=span)
        part *= slot >> SIZE_BITS
        plain.low[:n] += part
        plain.shift(n, span)
    decided, of_decided = plain.end()
    at = np.empty(count, np.int64)
    at[order] = np.arange(count)
    chosen, decided, out, digits_of = chosen.astype("<u2"), decided.astype("<u2"), [], []
    sizes = np.stack(([len(x) for x in names], totals, of_chosen), axis=1).astype("<u2")
    for i, k in enumerate(at.tolist()):
        parts = sizes[i].tobytes(), heads[i], chosen[i, : of_chosen[i]].tobytes(), decided[k, : of_decided[k]].tobytes()
        out += parts
        digits_of.append(sum(map(len, parts)) // 2)
    return b"".join(out), np.array(digits_of)


def decode(raw: bytes, digits_of: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The ids of every lane, from what ``encode`` gave and the lanes' lengths, longest first.

    A block whose head contradicts itself comes back empty. Other damage gives wrong ids, never an error.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        return decoded(raw, digits_of, lengths)


def decoded(raw: bytes, digits_of: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    count, steps = len(lengths), int(lengths[0])
    flat = np.frombuffer(raw, "<u2")
    begins = np.cumsum(digits_of) - digits_of
    heads, totals, at, at_decided = [], np.zeros(count, np.int64), begins.copy(), begins.copy()
    for i, (a, size, length) in enumerate(zip(begins.tolist(), digits_of.tolist(), lengths.tolist(), strict=True)):
        n_ids, total, chosen = flat[a : a + 3].tolist()
        body = a + 3 + head_digits(n_ids, total)
        found = None
        if 1 <= n_ids <= total <= length and body + chosen <= a + size:
            found = behead(raw[2 * a + 6 : 2 * body], n_ids, total)
        if found:
            totals[i], at[i], at_decided[i] = total, body, body + chosen
        heads.append(found)
    flat = np.concatenate((flat.astype(np.float64), np.zeros(steps + 8)))

    # The ids that order 0 decided.
    order = np.argsort(-totals, kind="stable")
    longest = int(totals.max())
    slots = np.zeros((count, longest), np.int32)
    for k, i in enumerate(order.tolist()):
        if heads[i]:
            before = heads[i][1]
            counts = np.concatenate((before[1:], totals[i : i + 1])) - before
            slots[k, : totals[i]] = ((before << SIZE_BITS) | counts).repeat(counts)
    slots, base = slots.ravel(), np.arange(count) * longest
    plain, spans = Reader(flat, at_decided[order]), np.full(count, TOP)
    last = (totals[order] - 1).astype(np.float64)
    part_of = 1 / np.maximum(totals[order], 1)
    begins = np.zeros((longest, count), np.int16)
    for t, n in enumerate(active(totals[order])):
        code, span = plain.code[:n], spans[:n]
        part = span * part_of[:n]
        np.floor(part, out=part)
        value = code / part
        np.fmin(value, last[:n], out=value)
        place = value.astype(np.int64)
        place += base[:n]
        slot = slots.take(place, mode="clip")
        np.multiply(part, slot & SIZE, out=span)
        slot >>= SIZE_BITS
        begins[t, :n] = slot
        part *= slot
        code -= part
        plain.shift(n, span)
    begins = np.ascontiguousarray(begins.T)
    most = max((len(h[0]) for h in heads if h), default=1)
    decided = np.zeros((count, steps + 1), np.int16)
    number_at = np.zeros(longest + 1, np.int16)
    for k, i in enumerate(order.tolist()):
        if heads[i]:
            number_at[heads[i][1]] = np.arange(1, len(heads[i][1]) + 1)
            number_at.take(begins[k, : totals[i]], out=decided[i, : totals[i]], mode="clip")
    decided = decided.ravel()
    reading = np.arange(count) * (steps + 1)
    model, mixed = Models(count, most), Reader(flat, at)
    numbers = np.zeros((steps, count), np.int16)
    for t, n in enumerate(active(lengths)):
        code = mixed.code[:n]
        model.predict(n)
        share = (code >= model.ends[1, :n]).astype(np.int64)
        share += code >= model.ends[2, :n]
        low, place = model.narrow(n, share)
        code -= low
        mixed.shift_few(n, model.ends[3, :n])
        decided.take(reading[:n], out=model.told[2, :n], mode="clip")
        reading[:n] += share >> 1
        number = model.told.ravel().take(place, mode="clip", out=numbers[t, :n])
        model.learn(n, number, share)
    numbers = np.ascontiguousarray(numbers.T)
    none = np.zeros(0, np.int64)
    return [
        np.concatenate((h[0][:1], h[0])).take(numbers[i, :size]) if h else none
        for i, (size, h) in enumerate(zip(lengths.tolist(), heads, strict=True))
    ]
