"""Byte-level BPE as a lazily determinised finite-state transducer, and its streaming decoder.

A sequence of tokens is the BPE encoding of its bytes exactly if every two neighbours are: merging their bytes gives these two
back.  Hence each prefix of a text has one last token, and the encoding of a prefix is that of the text before its last token,
plus this token.  Reading byte by byte, only positions from which some token of the vocabulary could still begin matter; once the
encodings of all of these share a first part, that part is certain.  So a state is the last certain token and the bytes after
it; a step by one byte leads to the next state and emits the tokens that have become certain, after a lookahead bounded by the
longest token.  States and steps are worked out when first met and kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

_NO_TOKEN = -1

# The splitting pattern of the public 50k vocabulary, within whose pieces merges stay.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Vocabulary of lines ``base64(token) rank``."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class Transducer:
    """Encodes pieces of text to token ids.  ``ranks`` maps the bytes of each token to its id, which is also its merge rank.

    At most ``limit`` steps are kept at a time; beyond, they are forgotten and worked out anew, with the same results.
    """

    def __init__(self, ranks: dict[bytes, int], limit: int = 2_000_000):
        self._ranks = ranks
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._limit = limit
        self._starts = {token[:k] for token in ranks for k in range(1, len(token) + 1)}
        self._longest = max(map(len, ranks), default=0)
        self._neighbours: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        self._states: dict[tuple[int, bytes], int] = {(_NO_TOKEN, b""): 0}
        self._keys: list[tuple[int, bytes]] = [(_NO_TOKEN, b"")]
        self._steps: dict[int, tuple[int, tuple[int, ...]]] = {}
        self._ends: dict[int, tuple[int, ...]] = {}

    def _restart(self, state: int) -> int:
        """Forgets all steps, also in the middle of a piece; gives the number that the state has afterwards."""
        key = self._keys[state]
        self._forget()
        if key not in self._states:
            self._states[key] = len(self._keys)
            self._keys.append(key)
        return self._states[key]

    def merged(self, text: bytes) -> list[int]:
        """Encoding by the merges themselves: always the leftmost pair of least rank."""
        parts = [bytes([b]) for b in text]
        while len(parts) > 1:
            pairs = [(self._ranks.get(a + b, 1 << 60), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, k = min(pairs)
            if rank == 1 << 60:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self._ranks[p] for p in parts]

    def _fit(self, left: int, right: int) -> bool:
        if left == _NO_TOKEN:
            return True
        fit = self._neighbours.get((left, right))
        if fit is None:
            if len(self._neighbours) >= self._limit:
                self._neighbours.clear()
            fit = self._neighbours[left, right] = self.merged(self._bytes[left] + self._bytes[right]) == [left, right]
        return fit

    def _last_tokens(self, certain: int, pending: bytes) -> list[tuple[int, int]]:
        """For each prefix of the pending bytes the (position, token) that its encoding ends with; position is where it begins."""
        last: list[tuple[int, int]] = [(_NO_TOKEN, certain)]
        for end in range(1, len(pending) + 1):
            for begin in range(max(0, end - self._longest), end):
                token = self._ranks.get(pending[begin:end])
                if token is not None and last[begin][1] != -2 and self._fit(last[begin][1], token):
                    last.append((begin, token))
                    break
            else:
                last.append((end - 1, -2))
        return last

    def _chain(self, last: list[tuple[int, int]], end: int) -> list[tuple[int, int]]:
        """(end position, token) of the encoding of the first ``end`` pending bytes."""
        chain = []
        while end > 0:
            begin, token = last[end]
            chain.append((end, token))
            end = begin
        return chain[::-1]

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        certain, pending = self._keys[state]
        pending += bytes([byte])
        last = self._last_tokens(certain, pending)
        end = len(pending)
        live = [self._chain(last, p) for p in range(end) if pending[p:] in self._starts] + [self._chain(last, end)]
        shared = 0
        while all(len(c) > shared for c in live) and len({c[shared] for c in live}) == 1:
            shared += 1
        emitted = tuple(token for _, token in live[-1][:shared])
        if shared:
            cut, certain = live[-1][shared - 1]
            pending = pending[cut:]
        key = (certain, pending)
        following = self._states.get(key)
        if following is None:
            following = self._states[key] = len(self._keys)
            self._keys.append(key)
        return following, emitted

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of one piece."""
        whole = self._ranks.get(piece)
        if whole is not None:
            return (whole,)
        state, out, steps = 0, [], self._steps
        for byte in piece:
            at = state << 8 | byte
            known = steps.get(at)
            if known is None:
                known = steps[at] = self._step(state, byte)
                if len(steps) > self._limit:
                    known = self._restart(known[0]), known[1]
                    steps = self._steps
            state, emitted = known
            if emitted:
                out.extend(emitted)
        rest = self._ends.get(state)
        if rest is None:
            certain, pending = self._keys[state]
            rest = self._ends[state] = tuple(token for _, token in self._chain(self._last_tokens(certain, pending), len(pending)))
        out.extend(rest)
        return tuple(out)


class Utf8:
    """Incremental UTF-8 decoder: a state machine over bytes that holds back at most three of them.

    Ill-formed input gives U+FFFD for each maximal part of a character, as the Unicode standard recommends.
    """

    def __init__(self) -> None:
        self._need, self._code, self._low, self._high = 0, 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out = []
        for byte in data:
            if self._need:
                if self._low <= byte <= self._high:
                    self._code, self._need = self._code << 6 | byte & 0x3F, self._need - 1
                    self._low, self._high = 0x80, 0xBF
                    if not self._need:
                        out.append(chr(self._code))
                    continue
                out.append("�")
                self._need, self._low, self._high = 0, 0x80, 0xBF
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xDF:
                self._need, self._code = 1, byte & 0x1F
            elif 0xE0 <= byte <= 0xEF:
                self._need, self._code = 2, byte & 0x0F
                self._low, self._high = (0xA0 if byte == 0xE0 else 0x80), (0x9F if byte == 0xED else 0xBF)
            elif 0xF0 <= byte <= 0xF4:
                self._need, self._code = 3, byte & 0x07
                self._low, self._high = (0x90 if byte == 0xF0 else 0x80), (0x8F if byte == 0xF4 else 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        rest = "�" if self._need else ""
        self._need, self._low, self._high = 0, 0x80, 0xBF
        return rest


def decode_stream(ids: Iterable[int], tokens: dict[int, bytes]) -> Iterator[str]:
    """The text of token ids, piece by piece as soon as its characters are whole.  An unknown id is an error."""
    machine = Utf8()
    for token in ids:
        if part := machine.feed(tokens[token]):
            yield part
    if rest := machine.end():
        yield rest
