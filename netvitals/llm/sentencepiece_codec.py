"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text is read as a space followed by itself; a space becomes the white-space marker that
begins the next word. Pieces hold markers only at their beginning, so the best segmentation
of a text is that of its words, each with the spaces before it. Words are segmented once per batch, all of a batch's distinct words in
step: every word walks the trie from each of its characters, and a position keeps the best
score and the piece that led there. A character no piece covers is written as its bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from netvitals.llm.words import pieces, word_hashes

MARKER = "▁".encode()
#: A character of bytes scores this much below the worst piece.
BYTE_PENALTY = 10.0
#: Longer words are segmented one by one.
LONG_WORD = 64


@dataclass
class Vocabulary:
    """Pieces in decoded form and the trie: from state s, byte c leads to base[s] + c + 1 if the
    check entry there is s; ``piece`` is the id a state completes, or -1."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    score: np.ndarray  # by piece id
    byte_ids: np.ndarray  # of the 256 byte pieces
    byte_score: float
    text: np.ndarray  # bytes of all pieces, decoded
    text_at: np.ndarray
    longest: int


def build_trie(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, piece) of a double-array trie that holds the given byte strings."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for word, number in sorted(words.items()):
        node = 0
        for c in word:
            nxt = children[node].get(c)
            if nxt is None:
                nxt = children[node][c] = len(children)
                children.append({})
                ends.append(-1)
            node = nxt
        ends[node] = number
    room = 2 * len(children) + 1024
    base, check, piece = np.zeros(room, np.int64), np.full(room, -1, np.int64), np.full(room, -1, np.int64)
    taken = bytearray(room)
    taken[0] = 1
    first_free, todo = 1, [(0, 0)]
    while todo:
        node, state = todo.pop()
        piece[state] = ends[node]
        signs = list(children[node])
        if not signs:
            continue
        while taken[first_free]:
            first_free += 1
        low, at = min(signs), max(first_free - min(signs) - 1, 0)
        while any(taken[at + c + 1] for c in signs):
            at = taken.index(0, at + low + 2) - low - 1
            if at + 512 > room:
                taken += bytearray(room)
                base, check, piece = (
                    np.concatenate([x, np.full(room, fill, np.int64)])
                    for x, fill in ((base, 0), (check, -1), (piece, -1))
                )
                room *= 2
        base[state] = at
        for c in signs:
            taken[at + c + 1] = 1
            check[at + c + 1] = state
            todo.append((children[node][c], at + c + 1))
    pad = 257  # a step never leaves the arrays
    used = int(np.flatnonzero(np.frombuffer(bytes(taken), np.uint8))[-1]) + pad + int(base.max())
    grow = max(0, used - room)
    return tuple(
        np.concatenate([x, np.full(grow, fill, np.int64)])[:used].astype(np.int32)
        for x, fill in ((base, 0), (check, -1), (piece, -1))
    )


def load_vocabulary(model_file: str) -> Vocabulary:
    """The pieces, scores and byte pieces of a SentencePiece model file, which is only read."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = model.get_piece_size()
    score = np.array([model.get_score(i) for i in range(n)], np.float64)
    shown, words, byte_ids = [], {}, np.full(256, -1, np.int64)
    for i in range(n):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            shown.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(i) or model.is_unused(i):
            shown.append(b"")
        elif model.is_unknown(i):
            shown.append(" ⁇ ".encode())
        else:
            shown.append(name.encode().replace(MARKER, b" "))
            words[name.encode()] = i
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte pieces")
    if any(MARKER in name.lstrip("▁").encode() for name in map(bytes.decode, words)):
        raise ValueError("pieces that reach over a word's beginning are not supported")
    base, check, piece = build_trie({w.replace(MARKER, b" "): i for w, i in words.items()})
    return Vocabulary(
        base, check, piece, score, byte_ids, min(score[i] for i in words.values()) - BYTE_PENALTY,
        np.frombuffer(b"".join(shown), np.uint8),
        np.concatenate([[0], np.cumsum([len(x) for x in shown])]),
        max(map(len, words)),
    )


def _char_lengths(data: np.ndarray) -> np.ndarray:
    """Bytes of the character that begins here; 0 inside a character."""
    return np.select([data < 0x80, data < 0xC0, data < 0xE0, data < 0xF0], [1, 0, 2, 3], 4).astype(np.int64)


def segment(v: Vocabulary, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts): the best pieces of the words ``data[start : start + size]``, in order.

    Ties go to the longer last piece: positions are filled from the left and only a better
    score replaces an earlier one.
    """
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    at = np.concatenate([[0], np.cumsum(size)])
    flat = data[_ragged(start, size)]
    jump = _char_lengths(flat)
    best = np.full(at[-1] + len(size), -np.inf)  # a place for the end of every word
    slot = at[:-1] + np.arange(len(size))
    best[slot] = 0.0
    back = np.full(len(best), -1, np.int64)  # the piece that ends here; -2: a character of bytes
    step = np.zeros(len(best), np.int64)
    owner_end = at[1:]
    long = int(np.searchsorted(-size, -LONG_WORD, "left"))
    for w in range(long):
        _one_by_one(v, flat[at[w] : at[w + 1]], jump[at[w] : at[w + 1]], best, back, step, int(slot[w]))
    words = np.arange(long, len(size))
    for i in range(int(size[long]) if long < len(size) else 0):
        words = words[: np.searchsorted(-size[words], -i, "left")]
        here = words[jump[at[words] + i] > 0]
        spot, place, end = at[here] + i, slot[here] + i, owner_end[here]
        state, depth, score = np.zeros(len(here), np.int64), 0, best[place]
        single = np.zeros(len(here), bool)
        width = jump[spot]
        live = np.arange(len(here))
        while len(live):
            live = live[spot[live] + depth < end[live]]
            nxt = v.base[state[live]] + flat[spot[live] + depth].astype(np.int64) + 1
            ok = v.check[nxt] == state[live]
            live, nxt = live[ok], nxt[ok]
            state[live] = nxt
            depth += 1
            done = v.piece[nxt]
            hit = np.flatnonzero(done >= 0)
            if len(hit):
                who, number = live[hit], done[hit].astype(np.int64)
                value, to = score[who] + v.score[number], place[who] + depth
                better = value > best[to]
                to, value, number = to[better], value[better], number[better]
                best[to], back[to], step[to] = value, number, depth
                single[who[width[who] == depth]] = True
        rest = np.flatnonzero(~single)
        value, to = score[rest] + v.byte_score, place[rest] + width[rest]
        better = value > best[to]
        to = to[better]
        best[to], back[to], step[to] = value[better], -2, width[rest][better]
    # From the ends back to the beginnings: the id at each piece's first byte.
    ids = np.full(at[-1], -1, np.int64)
    place, rank = slot + size, np.arange(len(size))
    rank = rank[size > 0]
    place = place[size > 0]
    while len(rank):
        n, number = step[place], back[place]
        place = place - n
        first = place - rank
        plain = number >= 0
        ids[first[plain]] = number[plain]
        for extra in range(4):
            more = first[~plain & (n > extra)] + extra
            ids[more] = v.byte_ids[flat[more]]
        open_ = place > slot[rank]
        rank, place = rank[open_], place[open_]
    begun = np.flatnonzero(ids >= 0)
    count = np.diff(np.searchsorted(begun, at))
    # Back in the order the words came in.
    where = np.empty(len(order), np.int64)
    where[order] = np.arange(len(order))
    head = np.cumsum(count) - count
    return ids[begun][_ragged(head[where], count[where])], count[where]


def _one_by_one(v, flat, jump, best, back, step, slot) -> None:
    """The same pass for one long word."""
    raw, n = flat.tobytes(), len(flat)
    base, check, piece = v.base, v.check, v.piece
    for i in range(n):
        if not jump[i]:
            continue
        state, single, score = 0, False, best[slot + i]
        for j in range(i, min(n, i + v.longest)):
            nxt = base[state] + raw[j] + 1
            if check[nxt] != state:
                break
            state, number = nxt, piece[nxt]
            if number >= 0:
                to, value = slot + j + 1, score + v.score[number]
                if value > best[to]:
                    best[to], back[to], step[to] = value, number, j + 1 - i
                single |= j + 1 - i == jump[i]
        to = slot + i + int(jump[i])
        if not single and score + v.byte_score > best[to]:
            best[to], back[to], step[to] = score + v.byte_score, -2, jump[i]


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of the ranges start .. start + size, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def as_read(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts as they are encoded: a space put before each that is not empty, a literal
    white-space marker read as a space (the library cannot tell them apart either)."""
    raw = data.tobytes()
    if MARKER in raw:
        texts = [raw[a:b].replace(MARKER, b" ") for a, b in zip(offsets[:-1], offsets[1:])]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    some = (np.diff(offsets) > 0).astype(np.int64)
    moved = offsets + np.concatenate([[0], np.cumsum(some)])
    out = np.full(moved[-1], 32, np.uint8)
    out[_ragged(moved[:-1] + some, np.diff(offsets))] = data
    return out, moved


def encode_texts(v: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) of texts in the form `as_read` gives them."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    head = data == 32
    head[1:] &= data[:-1] != 32
    head[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(head)
    size = np.diff(np.append(start, n))
    own = word_hashes(data, start, start + size, fold=False)
    _, at, same = np.unique(own, return_index=True, return_inverse=True)
    at, same = _apart(data, start, size, at, same)
    ids, count = segment(v, data, start[at], size[at])
    begin = np.cumsum(count) - count
    out = ids[_ragged(begin[same], count[same])]
    each = np.concatenate([[0], np.cumsum(count[same])])
    words = np.searchsorted(start, offsets)
    return out, np.diff(each[words])


def _apart(data, start, size, at, same):
    """(at, same) with words taken out that are not those of their hash. A hash of up to eight
    bytes is one word's alone, save among words of different lengths."""
    wrong = size != size[at[same]]
    long = np.flatnonzero((size > 8) & ~wrong)
    mine, other = data[_ragged(start[long], size[long])], data[_ragged(start[at[same[long]]], size[long])]
    differs = np.repeat(long, size[long])[mine != other]
    wrong[differs] = True
    alone = np.flatnonzero(wrong)
    if len(alone):
        same = same.copy()
        same[alone] = len(at) + np.arange(len(alone))
        at = np.concatenate([at, alone])
    return at, same


def decode_ids(v: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts behind the ids: piece texts joined, markers as spaces,
    without the space that was put before the text."""
    size = v.text_at[ids + 1] - v.text_at[ids]
    data = v.text[_ragged(v.text_at[ids], size)]
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
    first = ends[:-1][np.diff(ends) > 0]
    first = first[data[first] == 32]
    keep = np.ones(len(data), bool)
    keep[first] = False
    return data[keep], ends - np.searchsorted(first, ends)


def encode_documents(docs: DataFrame, model_file: str, text: str = "text", check: bool = True) -> DataFrame:
    """``docs`` with ``token_ids array<int>, n_tokens int`` and, if asked, ``round_trip boolean``
    (the decoded ids equal the text as read) in the place of the text.

    Null and empty texts have no tokens and round-trip; texts of any length are encoded
    whole; repeated rows alike. Columns of those names in ``docs`` are replaced, others pass
    through unread. The vocabulary's size bounds what is sent to tasks.
    """
    v = load_vocabulary(model_file)
    added = {"token_ids": "array<int>", "n_tokens": "int"} | ({"round_trip": "boolean"} if check else {})
    names = [c for c in docs.columns if c not in added and c != text]
    shape = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema]
        + [f"{k} {t}" for k, t in added.items()]
    )

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in pieces(batch.column(len(names))):
                data, offsets = as_read(data, offsets)
                ids, counts = encode_texts(v, data, offsets)
                cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                out = [batch.column(i).slice(lo, hi - lo) for i in range(len(names))]
                out.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids.astype(np.int32))))
                out.append(pa.array(counts.astype(np.int32)))
                if check:
                    out.append(pa.array(_equal(data, offsets, *decode_ids(v, ids, counts))))
                yield pa.RecordBatch.from_arrays(out, names=[*names, *added])

    return docs.select(*names, text).mapInArrow(run, shape)


def _equal(data, offsets, got, ends) -> np.ndarray:
    """Whether each decoded text is the text as read without its first space."""
    some = (np.diff(offsets) > 0).astype(np.int64)
    same = np.diff(offsets) - some == np.diff(ends)
    size = np.where(same, np.diff(ends), 0)
    differs = data[_ragged(offsets[:-1] + some, size)] != got[_ragged(ends[:-1], size)]
    wrong = np.bincount(np.repeat(np.arange(len(same)), size)[differs], minlength=len(same))
    return same & (wrong == 0)


def decode_documents(encoded: DataFrame, model_file: str, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with a column ``text`` decoded from the ids in their place; null ids as none.
    Bytes that form no valid UTF-8 become the replacement character."""
    v = load_vocabulary(model_file)
    names = [c for c in encoded.columns if c not in (ids, "text")]
    shape = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*names).schema] + ["text string"]
    )

    def run(batches):
        for batch in batches:
            lists = batch.column(len(names))
            counts = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64)
            data, ends = decode_ids(v, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*names, "text"])

    return encoded.select(*names, ids).mapInArrow(run, shape)
