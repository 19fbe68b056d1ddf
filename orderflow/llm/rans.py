"""Static range asymmetric numeral system over interleaved lanes, in numpy.

Symbols of a block are dealt to its lanes in turn; each lane has a 64-bit state in
[2^31, 2^63) and gives or takes 32-bit words.  Coding goes backwards, so decoding goes forwards,
a row of lanes at a time.  Blocks are independent: they share only the frequency table.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

BITS = 18
#: Rows a block should have; its lanes are a power of two within these bounds.
ROWS, FEWEST_LANES, MOST_LANES = 256, 16, 4096
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
#: Rows of lanes between two checkpoints.
CHECKPOINT_ROWS = 128


def lanes_for(n: int) -> int:
    return min(MOST_LANES, max(FEWEST_LANES, 1 << max(0, n // ROWS).bit_length() - 1 if n >= ROWS else 1))


def quantised(counts: np.ndarray) -> np.ndarray:
    """Frequencies adding up to 2^BITS, at least 1 for every symbol that occurs."""
    total, size = int(counts.sum()), 1 << BITS
    used = counts > 0
    if not used.any():
        return np.zeros(len(counts), np.int64)
    if used.sum() > size:
        raise ValueError("more symbols than frequency slots")
    freq = np.where(used, np.maximum(1, np.round(counts.astype(float) * size / total)), 0).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    while (excess := int(freq.sum()) - size) > 0:  # many symbols were raised to 1: take from the frequent
        room = np.maximum(freq[order] - 1, 0)
        take = np.minimum(room, -(-room * excess // max(1, room.sum())))
        over = np.cumsum(take) - take
        freq[order] -= np.minimum(take, np.maximum(0, excess - over))
    freq[order[0]] += size - int(freq.sum())
    return freq


@dataclass
class Table:
    """What coder and decoder share: by symbol and by slot."""

    freq: np.ndarray
    first: np.ndarray
    symbol: np.ndarray
    slot_freq: np.ndarray
    slot_rest: np.ndarray
    inverse: np.ndarray

    @classmethod
    def of(cls, freq: np.ndarray) -> Table:
        freq = np.asarray(freq, np.int64)
        first = np.cumsum(freq) - freq
        symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        return cls(freq.astype(np.uint64), first.astype(np.uint64), symbol,
                   freq[symbol].astype(np.uint64), (np.arange(len(symbol)) - first[symbol]).astype(np.uint64),
                   1.0 / np.maximum(freq, 1))


def encode(ids: np.ndarray, table: Table) -> dict:
    """One block: words, final states and checkpoints (row, word position, states)."""
    lanes = lanes_for(len(ids))
    rows = -(-len(ids) // lanes)
    filled = np.zeros(rows * lanes, np.uint32)
    filled[:len(ids)] = ids
    if len(ids):
        filled[len(ids):] = ids[0]  # padding; the count of ids is stored
    filled = filled.reshape(rows, lanes)
    if not table.freq[np.flatnonzero(np.bincount(ids))].all():
        raise ValueError("an id without a frequency")
    shift, size = np.uint64(63 - BITS), np.uint64(1 << BITS)
    state = np.full(lanes, LOW)
    pieces, marks, written = [], [], 0
    for row in range(rows - 1, -1, -1):
        symbols = filled[row]
        freq = table.freq[symbols]
        full = np.flatnonzero(state >= freq << shift)
        if len(full):
            out = state[full]
            pieces.append(out.astype(np.uint32))
            written += len(full)
            state[full] = out >> WORD
        # state // freq: the float quotient is under 2^45, so off by one at most
        high = (state.astype(np.float64) * table.inverse[symbols]).astype(np.uint64)
        rest = (state - high * freq).view(np.int64)
        high -= rest < 0
        high += rest >= freq.view(np.int64)
        state += high * (size - freq)
        state += table.first[symbols]
        if row and row % CHECKPOINT_ROWS == 0:
            marks.append((row, written, state.copy()))
    words = np.concatenate(pieces[::-1]) if pieces else np.zeros(0, np.uint32)
    payload = words.astype("<u4").tobytes()
    marks.reverse()
    return {"lanes": lanes, "payload": payload, "states": state.astype("<u8").tobytes(),
            "mark_rows": [r for r, _, _ in marks], "mark_words": [len(words) - w for _, w, _ in marks],
            "mark_states": b"".join(s.astype("<u8").tobytes() for _, _, s in marks)}


def checksum(*parts: bytes | int | None | list) -> int:
    """CRC-32 of all parts; numbers count as 64-bit integers, a null as a mark of its own, lists by
    their length and items, so that no part can pass for another."""
    crc = 0
    for part in parts:
        if isinstance(part, bytes):
            crc = zlib.crc32(part, zlib.crc32(len(part).to_bytes(8, "little"), crc))
        elif isinstance(part, list):
            known = np.array([x is not None for x in part], np.uint8)
            items = np.array([x or 0 for x in part], "<i8")
            crc = checksum(crc, len(part), known.tobytes(), items.tobytes())
        else:
            crc = zlib.crc32(int(part).to_bytes(8, "little", signed=True), crc)
    return crc


def crc_of_both(first: int, second: int, size: int) -> int:
    """CRC-32 of two strings in a row from their own, the second having ``size`` bytes.

    Appending a zero byte is linear over the bits of the sum, so ``size`` of them are applied by
    repeated squaring of that map; the second string's sum is then added.
    """
    column = [1 << bit for bit in range(32)]
    step = [_with_zero_bit(c) for c in column]
    for _ in range(3):  # a zero bit, two, four, eight
        step = [_applied(step, c) for c in step]
    while size:
        if size & 1:
            first = _applied(step, first)
        step = [_applied(step, c) for c in step]
        size >>= 1
    return first ^ second


def _with_zero_bit(crc: int) -> int:
    return crc >> 1 ^ (0xEDB88320 if crc & 1 else 0)


def _applied(columns: list[int], value: int) -> int:
    out, bit = 0, 0
    while value:
        if value & 1:
            out ^= columns[bit]
        value, bit = value >> 1, bit + 1
    return out


def decode(block: dict, n: int, table: Table, mark: int | None = None, rows: int | None = None,
           last: bool = True) -> np.ndarray:
    """The ids of a block of ``n``; from checkpoint ``mark`` on and for ``rows`` rows, if given.

    A stretch between two checkpoints is a block with ``last=False``: its states end anywhere.

    What is decoded has to be sound: the files' reader holds ``checksum`` against the block first.
    """
    lanes = block["lanes"]
    words = np.frombuffer(block["payload"], "<u4").astype(np.uint64)
    row, at = (0, 0) if mark is None else (block["mark_rows"][mark], block["mark_words"][mark])
    states = block["states"] if mark is None else block["mark_states"][mark * 8 * lanes:(mark + 1) * 8 * lanes]
    state = np.frombuffer(states, "<u8").astype(np.uint64)
    total = -(-n // lanes)
    end = total if rows is None else min(total, row + rows)
    slots = np.empty((max(0, end - row), lanes), np.int64)
    mask, bits = np.uint64((1 << BITS) - 1), np.uint64(BITS)
    for i in range(end - row):
        slot = slots[i]
        np.bitwise_and(state, mask, out=slot, casting="unsafe")
        state >>= bits
        state *= table.slot_freq[slot]
        state += table.slot_rest[slot]
        low = np.flatnonzero(state < LOW)
        if len(low):
            state[low] = (state[low] << WORD) | words[at:at + len(low)]
            at += len(low)
    if last and end == total and (at != len(words) or (state != LOW).any()):
        raise ValueError("a block does not end as it began")
    return table.symbol[slots.ravel()][:n - row * lanes]
