"""Near-duplicate passages by compact windows.

A document is a sequence of shingles of five words. Under one hash function, the nodes of
the Cartesian tree over the shingles' hashes group all passages that share a minimum: the
node at ``c`` with reach ``l`` to ``r`` stands for every passage within the reach that
holds ``c``. Nodes whose reach is at least ``WINDOW`` shingles are kept as compact windows.

Blocks of documents ask which shingles several documents have. Only windows of ``WINDOW``
shingles are followed of which three quarters are shared. Equal ones are found first, by
their sets of shingles: each learns the first document that has it. What is left are
distinct contents. They meet around the centres of their compact windows: first each with
the first document of its centre, then what is still unexplained with all documents of it,
in tiles. So a passage that a third of the corpus shares stands once in the last rounds.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm import sharing
from sheafwork.llm.hashing import mixed, raw, seeds, shingle_hashes, word_hashes_of
from sheafwork.llm.tables import written

SHINGLE = 5
#: Shingles in a passage of 50 words.
WINDOW = 46
FUNCTIONS = 8
#: Entries of a centre that meet in one task, on each side.
TILE = 256
#: Groups that tiles are dealt to, a block of documents.
BUCKETS = 4
#: Of two windows without repeats as many shingles have to be shared for 0.75.
_LEAST_SHARED = -(-150 * WINDOW // 175)
_SLICE_SHINGLES = 1 << 17
#: Bytes of texts whose words are hashed at once.
_SLICE_BYTES = 1 << 18
_SEEDS = seeds(FUNCTIONS, 5_000)

_SENT = "shard long, block long, keys binary, docs binary, places binary"
#: An entry, a region with its shingles, or what a block reports once the rest is known.
_LOOKED = (
    "kind int, key long, doc long, region long, base long, size int, least int, shingles binary, "
    "places binary, known binary, block long, docs binary, runs binary, texts binary, contents binary"
)
_ENTRY, _REGION, _BLOCK = range(3)
_FOUND = "doc long, content long, other long, place long, similarity double"
_STARRED = f"key long, region long, base long, size int, parts int, wanted array<long>, {_FOUND}"
PASSAGES = (
    "doc_id long, start long, end long, other_id long, other_start long, similarity double"
)


def compact_windows(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(left, centre, right)`` of the windows of at least ``WINDOW`` values.

    ``values`` holds sequences one after the other, ``ends`` the ends of each. Of equal
    values the one on the left counts as smaller.
    """
    size = len(values)
    fenced = np.zeros(size + len(ends) + 1, np.uint64)
    text = np.searchsorted(ends, np.arange(size), side="right")
    place = np.arange(size) + text + 1
    # A fence before, between and behind the sequences is below every value.
    fenced[place] = np.maximum(values, np.uint64(1))
    levels = [fenced]
    # No reach is longer than the longest sequence.
    longest = max(int(np.diff(np.r_[0, ends]).max(initial=0)), WINDOW) + 1
    while (1 << len(levels)) <= min(longest, len(fenced)):
        step = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
    # A centre is the smallest of some WINDOW values: only such places are followed.
    wide = max(k for k in range(len(levels)) if (1 << k) <= WINDOW)
    reach = 1 << wide
    if len(levels[wide]) <= WINDOW - reach:
        return (np.zeros(0, np.int64),) * 3
    lows = np.minimum(levels[wide][: len(levels[wide]) - (WINDOW - reach)], levels[wide][WINDOW - reach :])
    best = np.zeros(len(fenced), np.uint64)
    best[: len(lows)] = lows
    # The largest minimum of the windows that hold a place, by the same doubling.
    cover = np.zeros(len(fenced) + WINDOW, np.uint64)
    cover[WINDOW - 1 : WINDOW - 1 + len(fenced)] = best
    for k in range(wide):
        cover = np.maximum(cover[: -(1 << k)], cover[1 << k :])
    cover = np.maximum(cover[: len(fenced)], cover[WINDOW - reach : WINDOW - reach + len(fenced)])
    centre = place[fenced[place] == cover[place]]
    value = fenced[centre]
    left, right = centre.copy(), centre.copy()
    for k in range(len(levels) - 1, -1, -1):
        step, level = 1 << k, levels[k]
        to = left - step
        ok = (to >= 0) & (level[np.maximum(to, 0)] > value)
        left[ok] = to[ok]
        to = right + 1
        ok = to + step <= len(fenced)
        ok &= level[np.minimum(to, len(level) - 1)] >= value
        right[ok] += step
    keep = right - left + 1 >= WINDOW
    shift = np.searchsorted(place, centre[keep]) - centre[keep]
    return left[keep] + shift, centre[keep] + shift, right[keep] + shift


def _slices(texts: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= _SLICE_SHINGLES:
            yield first, texts[first : k + 1]
            first, size = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _windows(texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Function, centre shingle, text, left, centre and right of all compact windows."""
    out = []
    for offset, some in _slices(texts):
        flat = np.concatenate(some)
        ends = np.cumsum([len(x) for x in some])
        starts = ends - [len(x) for x in some]
        for function, seed in enumerate(_SEEDS):
            left, centre, right = compact_windows(mixed(flat ^ seed), ends)
            text = np.searchsorted(ends, centre, side="right")
            base = starts[text]
            function = np.full(len(centre), function)
            out.append((function, flat[centre], text + offset, left - base, centre - base, right - base))
    if not out:
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _numbered(rows: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    known = [(i, t) for i, t in zip(rows["doc_id"].to_pylist(), raw(rows["text"])) if i is not None]
    known.sort(key=lambda row: row[0])
    ids, texts, size = np.array([i for i, _ in known], np.int64), [], 0
    some: list[bytes] = []
    for number, (_, text) in enumerate(known, 1):
        some.append(text)
        size += len(text)
        if size >= _SLICE_BYTES or number == len(known):
            texts += _shingles(some)
            some, size = [], 0
    return ids, texts


def _shingles(texts: list[bytes]) -> list[np.ndarray]:
    """The shingles of each text; fewer words than make one have none."""
    hashes, ends = word_hashes_of(texts)
    if len(hashes) < SHINGLE:
        return [hashes[:0]] * len(texts)
    # Shingles that begin in one text and end in another are left out.
    flat, starts = shingle_hashes(hashes), np.r_[0, ends[:-1]]
    return [flat[a : max(a, b - SHINGLE + 1)] for a, b in zip(starts.tolist(), ends.tolist())]


def _block(rows: pa.Table) -> int:
    return rows["block"][0].as_py() if len(rows) else 0


def _flat(ids: np.ndarray, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of a block and the document of each."""
    return np.concatenate([np.zeros(0, np.uint64), *texts]), np.repeat(ids, [len(x) for x in texts])


def _ask(shards: int) -> Callable[[pa.Table], pa.Table]:
    def ask(rows: pa.Table) -> pa.Table:
        short, shard, several, _ = sharing.distinct(*_flat(*_numbered(rows)), shards)
        return sharing.asked(_block(rows), short, shard, several)

    return ask


def _summed(values: np.ndarray, *weights: np.ndarray) -> Iterator[np.ndarray]:
    """For each window the sum of the weights of its distinct values."""
    order = np.argsort(values, kind="stable")
    before = np.full(len(values), -1)
    same = values[order[1:]] == values[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    place = np.arange(len(values))
    count = len(values) - WINDOW + 1
    first = np.maximum(np.maximum(before, place - WINDOW) + 1, 0)
    last = np.minimum(place, count - 1)
    ok = first <= last
    for weight in weights:
        steps = np.zeros(count + 1, weight.dtype)
        np.add.at(steps, first[ok], weight[ok])
        np.subtract.at(steps, last[ok] + 1, weight[ok])
        yield np.cumsum(steps, dtype=weight.dtype)[:count]


def _in_windows(weights: np.ndarray) -> np.ndarray:
    """For each window the sum of all its weights."""
    sums = np.cumsum(weights, dtype=weights.dtype)
    sums[WINDOW:] -= sums[:-WINDOW].copy()
    return sums[WINDOW - 1 :]


def _contents(ids: np.ndarray, texts: list[np.ndarray], answers: pa.Table, shards: int) -> tuple[np.ndarray, ...]:
    """Windows that can be alike to one of another document: text, place, hash of the set,
    size of the set, how many of it are shared, shard, by shard, hash and document; and
    where each hash starts."""
    flat, docs = _flat(ids, texts)
    _, shard, _, spot = sharing.distinct(flat, docs, shards)
    bits = sharing.shared(answers, shard)[spot].astype(np.int64)
    out, end = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2], 0
    weights, seen = mixed(flat), np.empty(len(shard), np.int64)
    for k, text in enumerate(texts):
        run, end = slice(end, end + len(text)), end + len(text)
        if len(text) < WINDOW:
            continue
        number = np.arange(len(text))
        seen[spot[run]] = number
        if (seen[spot[run]] == number).all():
            # No shingle stands twice.
            content, known = (_in_windows(x[run]) for x in (weights, bits))
            held = np.full(len(known), WINDOW)
        else:
            content, held, known = _summed(text, weights[run], np.ones(len(text), np.int64), bits[run])
        place = np.flatnonzero(100 * known >= 75 * held)
        out.append((np.full(len(place), k), place, content[place], held[place], known[place]))
    text, place, content, held, known = (np.concatenate(x) for x in zip(*out))
    shard = (content % np.uint64(shards)).astype(np.int64)
    if (np.diff(ids) <= 0).any():
        # Rows come in no order, and a document may have several.
        order = np.lexsort((place, ids[text]))
        order = order[np.argsort(content[order], kind="stable")]
    else:
        order = np.argsort(content, kind="stable")
    # Shards are few: sorting short numbers takes no comparisons.
    order = order[np.argsort(shard[order].astype(np.uint16) if shards <= 1 << 16 else shard[order], kind="stable")]
    columns = [x[order] for x in (text, place, content, held, known, shard)]
    content = columns[2]
    fresh = np.flatnonzero(np.r_[True, content[1:] != content[:-1]][: len(content)])
    return *columns, fresh


def _send(shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def send(rows: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = _numbered(rows)
        text, place, content, _, _, shard, fresh = _contents(ids, texts, answers, shards)
        places = place[fresh].astype("<u4")
        docs, keys = ids[text[fresh]].astype("<i8"), content[fresh].astype("<u8")
        runs = sharing._runs(shard[fresh])
        return pa.table(
            {
                "shard": pa.array([k for k, _ in runs], pa.int64()),
                "block": pa.array([_block(rows)] * len(runs), pa.int64()),
                "keys": pa.array([keys[run].tobytes() for _, run in runs], pa.binary()),
                "docs": pa.array([docs[run].tobytes() for _, run in runs], pa.binary()),
                "places": pa.array([places[run].tobytes() for _, run in runs], pa.binary()),
            }
        )

    return send


def _first(rows: pa.Table) -> pa.Table:
    """For a shard: the first document of every window with its place, for all blocks but
    the one that has it. An answer lists places among the keys sent, documents, places."""
    keys, docs, places = (
        np.frombuffer(b"".join(rows[c].to_pylist()), k)
        for c, k in (("keys", "<u8"), ("docs", "<i8"), ("places", "<u4"))
    )
    numbers = np.array([len(x) // 8 for x in rows["keys"].to_pylist()])
    place = np.arange(len(keys)) - np.repeat(np.cumsum(numbers) - numbers, numbers)
    order = np.lexsort((docs, keys))
    fresh = np.r_[True, keys[order[1:]] != keys[order[:-1]]]
    lead = np.empty(len(keys), np.int64)
    lead[order] = order[np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))]
    later = docs[lead] < docs
    answers = []
    for start, number in zip(np.cumsum(numbers) - numbers, numbers):
        own = start + np.flatnonzero(later[start : start + number])
        parts = (place[own].astype("<u4"), docs[lead[own]], places[lead[own]])
        answers.append(len(own).to_bytes(4, "little") + b"".join(x.tobytes() for x in parts))
    return pa.table(
        {
            "block": rows["block"],
            "shard": rows["shard"],
            "kind": pa.array(np.ones(len(answers), np.int32)),
            "answer": pa.array(answers, pa.binary()),
        }
    )


def _leads(ids: np.ndarray, texts: list[np.ndarray], answers: pa.Table, shards: int) -> tuple[np.ndarray, ...]:
    """As :func:`_contents`, with the first document of all of each hash and its place."""
    kind = answers["kind"].to_numpy()
    asked, told = (answers.filter(pa.array(kind == k)) for k in (0, 1))
    columns = _contents(ids, texts, asked, shards)
    text, place, shard, fresh = columns[0], columns[1], columns[5], columns[6]
    lead, lead_place = ids[text[fresh]], place[fresh].copy()
    own = dict(zip(told["shard"].to_pylist(), told["answer"].to_pylist()))
    for k, run in sharing._runs(shard[fresh]):
        if k in own:
            number = int.from_bytes(own[k][:4], "little")
            spot = run.start + np.frombuffer(own[k], "<u4", number, 4)
            lead[spot] = np.frombuffer(own[k], "<i8", number, 4 + 4 * number)
            lead_place[spot] = np.frombuffer(own[k], "<u4", number, 4 + 12 * number)
    return *columns, lead, lead_place


def _table(schema: str, **columns: object) -> pa.Table:
    """A table of a schema; columns that are not given are null."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    size = len(next(iter(columns.values())))
    fields = [field.split() for field in schema.split(", ")]
    return pa.table(
        [pa.array(columns[n], kinds[k]) if n in columns else pa.nulls(size, kinds[k]) for n, k in fields],
        names=[n for n, _ in fields],
    )


def _runs_of_first(text: np.ndarray, place: np.ndarray, first: np.ndarray, spot: np.ndarray) -> np.ndarray:
    """Rows of text, first and last place, first document and place in it: windows one after
    the other that repeat one document."""
    order = np.lexsort((first, place, text))
    text, place, first, spot = (x[order].astype(np.int64) for x in (text, place, first, spot))
    same = (text[1:] == text[:-1]) & (first[1:] == first[:-1]) & (place[1:] == place[:-1] + 1)
    start = np.flatnonzero(np.r_[True, ~same][: len(text)])
    end = np.r_[start[1:], len(text)][: len(start)] - 1
    return np.stack([text[start], place[start], place[end], first[start], spot[start]], 1)


def _looked(shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Entries, around each centre the windows of contents that no earlier document has; the
    regions of texts that entries lie in; and the windows that a block reports or may report."""

    def looked(rows: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = _numbered(rows)
        number = _block(rows)
        text, place, content, held, known, _, fresh, lead, lead_place = _leads(ids, texts, answers, shards)
        group = np.repeat(np.arange(len(fresh)), np.diff(np.r_[fresh, len(text)]))
        repeats = lead[group] < ids[text]
        runs = _runs_of_first(text[repeats], place[repeats], lead[group][repeats], lead_place[group][repeats])
        own = np.flatnonzero(~repeats)
        own = own[np.lexsort((place[own], text[own]))]
        # Places one after the other are kept as steps of one, which pack well.
        steps = np.diff(place[own], prepend=0).astype("<i4")
        block = _table(
            _LOOKED,
            kind=[_BLOCK],
            block=[number],
            docs=[ids.astype("<i8").tobytes()],
            runs=[runs.astype("<i8").tobytes()],
            texts=[text[own].astype("<u4").tobytes()],
            places=[steps.tobytes()],
            contents=[content[own].astype("<u8").tobytes()],
        )
        new = fresh[lead == ids[text[fresh]]]
        new = new[np.lexsort((place[new], text[new]))]
        text, place, held, known = (x[new] for x in (text, place, held, known))
        span = np.int64(1 << 40)
        spots = text * span + place
        # Centres are looked for where windows are followed, with all windows that share a shingle.
        begins = np.flatnonzero(np.r_[True, np.diff(spots) >= WINDOW][: len(spots)])
        ends = np.r_[begins[1:], len(spots)][: len(begins)] - 1
        holder, begin = text[begins], np.maximum(place[begins] - WINDOW + 1, 0)
        cuts = zip(holder.tolist(), begin.tolist(), (place[ends] + 2 * WINDOW - 1).tolist())
        _, _, piece, left, centre, right = _windows([texts[k][x:y] for k, x, y in cuts])
        owner, left, centre, right = holder[piece], *(x + begin[piece] for x in (left, centre, right))
        low, high = np.maximum(left, centre - WINDOW + 1), np.minimum(right - WINDOW + 1, centre)
        # Functions with the same centre make one entry.
        order = np.lexsort((centre, owner))
        owner, centre, low, high = (x[order] for x in (owner, centre, low, high))
        start = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (centre[1:] != centre[:-1])][: len(owner)])
        if len(start):
            owner, centre = owner[start], centre[start]
            low, high = np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)
        first, last = np.searchsorted(spots, owner * span + low), np.searchsorted(spots, owner * span + high, "right")
        some = np.flatnonzero(first < last)
        if not len(some):
            return block
        owner, centre, first, last = owner[some], centre[some], first[some], last[some]
        least = np.minimum.reduceat(np.r_[held, held[-1]], np.stack([first, last], 1).ravel())[::2]
        at, end = place[first], place[last - 1] + WINDOW
        # Entries that overlap lie in one region.
        order = np.lexsort((at, owner))
        reach = np.maximum.accumulate((owner * span + end)[order])
        fresh = np.r_[True, (owner * span + at)[order][1:] > reach[:-1]]
        region = np.empty(len(order), np.int64)
        region[order] = np.cumsum(fresh) - 1
        begins = np.flatnonzero(fresh)
        holder, begin = owner[order][begins], at[order][begins]
        finish = reach[np.r_[begins[1:], len(order)] - 1] - holder * span
        spans = list(zip(holder.tolist(), begin.tolist(), finish.tolist()))
        cuts = [slice(*np.searchsorted(spots, [k * span + x, k * span + y - WINDOW + 1])) for k, x, y in spans]
        entries = _table(
            _LOOKED,
            kind=np.full(len(owner), _ENTRY, np.int32),
            key=np.concatenate(texts)[np.cumsum([0, *map(len, texts)])[owner] + centre].view(np.int64),
            doc=ids[owner],
            region=(number << 32) + region,
            base=at,
            size=(end - at).astype(np.int32),
            least=least.astype(np.int32),
        )
        regions = _table(
            _LOOKED,
            kind=np.full(len(spans), _REGION, np.int32),
            doc=ids[holder],
            region=(number << 32) + np.arange(len(spans)),
            base=begin,
            shingles=[texts[k][x:y].astype("<u8").tobytes() for k, x, y in spans],
            places=[place[cut].astype("<u4").tobytes() for cut in cuts],
            known=[known[cut].astype("<u4").tobytes() for cut in cuts],
        )
        return pa.concat_tables([block, entries, regions])

    return looked


def _content(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each window's set, and the size of the set."""
    content, held = _summed(shingles, mixed(shingles), np.ones(len(shingles), np.int64))
    return content.view(np.int64), held


def _on_one_diagonal(
    one: np.ndarray, shift: int, places: np.ndarray, first: np.ndarray | int, last: np.ndarray | int
) -> tuple[np.ndarray, np.ndarray]:
    """For windows at ``places`` the window of the other text between ``first`` and ``last`` that
    shares most shingles, and how many.

    ``one`` tells which shingles stand in the other text, each ``shift`` places on. Of windows
    that share as many the first is taken.
    """
    before = np.zeros(len(one) + 1, np.int64)
    np.cumsum(one, out=before[1:])
    latest = np.maximum.accumulate(np.where(one, np.arange(len(one)), -1))
    nearest = np.minimum(np.maximum(places, first - shift), last - shift)
    low, high = np.maximum(places, nearest), np.minimum(places, nearest) + WINDOW - 1
    number = before[np.maximum(high + 1, 0)] - before[np.minimum(low, len(one))]
    return np.maximum(latest[np.maximum(high, 0)] + shift - WINDOW + 1, first), number


def _alike(
    one: np.ndarray, two: np.ndarray, places: np.ndarray, plain: bool | None = None
) -> list[tuple[int, int, float]]:
    """``(place in one, place in two, similarity)``: of windows of ``one`` at ``places`` the
    most similar one of ``two``, where any has 0.75 or more. ``plain`` tells that neither
    text has a shingle twice, if that is known."""
    if plain or len(np.unique(one)) == len(one) and len(np.unique(two)) == len(two):
        same = one[:, None] == two[None, :]
        x, y = np.divmod(np.flatnonzero(same), len(two))
        if len(x) < _LEAST_SHARED:
            return []
        if (y - x == y[0] - x[0]).all():
            best, number = _on_one_diagonal(same.any(1), int(y[0] - x[0]), places, 0, len(two) - WINDOW)
        else:
            sums = np.zeros((len(one) + 1, len(two) + 1), np.int64)
            sums[1:, 1:] = same.cumsum(0).cumsum(1)
            shared = sums[WINDOW:, WINDOW:] - sums[:-WINDOW, WINDOW:] - sums[WINDOW:, :-WINDOW] + sums[:-WINDOW, :-WINDOW]
            shared = shared[places]
            best = shared.argmax(1)
            number = shared[np.arange(len(places)), best]
        hit = 100 * number >= 75 * (2 * WINDOW - number)
        values = number[hit] / (2 * WINDOW - number[hit])
        return list(zip(places[hit].tolist(), best[hit].tolist(), values.tolist()))
    _, code = np.unique(np.concatenate([one, two]), return_inverse=True)
    own, other = _sets(code[: len(one)], int(code.max()) + 1), _sets(code[len(one) :], int(code.max()) + 1)
    own = own[places]
    hit, best, value = _most_alike(own, other, own.sum(1))
    return list(zip(places[hit].tolist(), best[hit].tolist(), value[hit].tolist()))


def _sets(code: np.ndarray, size: int) -> np.ndarray:
    """A row a window: a one for each of ``size`` shingles that stands in it."""
    before = np.zeros((len(code) + 1, size), np.int16)
    before[np.arange(1, len(code) + 1), code] = 1
    np.cumsum(before, axis=0, out=before)
    # Sums of products of ones are exact in single precision.
    return (before[WINDOW:] > before[:-WINDOW]).astype(np.float32)


def _most_alike(one: np.ndarray, two: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each set of ``one``, which holds ``held`` shingles in all, whether one of ``two`` is alike;
    the most similar one, of those as similar the first; and the similarity."""
    shared = (one @ two.T).astype(np.int64)
    union = (held[:, None] + two.sum(1)[None, :]).astype(np.int64) - shared
    values = np.where(100 * shared >= 75 * union, shared / np.maximum(union, 1), 0)
    best = values.argmax(1)
    value = values[np.arange(len(values)), best]
    return value > 0, best, value


class _Region:
    """A region that a block's entries or the first entries of their centres lie in."""

    def __init__(self, base: int, shingles: bytes, places: bytes, known: bytes) -> None:
        self.base = base
        self.text = np.frombuffer(shingles, "<u8")
        #: Places of the windows that are followed, and how many of their shingles are shared.
        self.places = np.frombuffer(places, "<u4").astype(np.int64) - base
        self.known = np.frombuffer(known, "<u4").astype(np.int64)

    @functools.cached_property
    def order(self) -> np.ndarray:
        return np.argsort(self.text, kind="stable")

    @functools.cached_property
    def plain(self) -> bool:
        """No shingle stands twice."""
        return bool((np.diff(self.text[self.order]) != 0).all())

    @functools.cached_property
    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        return _content(self.text)

    def places_in(self, other: _Region) -> tuple[np.ndarray, np.ndarray]:
        """Which shingles stand in the other region, which has no repeats, and their places there."""
        place = np.searchsorted(other.text, self.text, sorter=other.order)
        place = other.order[np.minimum(place, len(other.text) - 1)]
        return other.text[place] == self.text, place


def _nearest(found: list[np.ndarray], similarity: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each document and content the most similar window, that of the first document, the
    first one. Rows of ``found`` are document, content, other document, place."""
    rows = np.concatenate([np.zeros((0, 4), np.int64), *found])
    values = np.concatenate([np.zeros(0), *similarity])
    doc, content, other, place = rows.T
    order = np.lexsort((place, other, -values, content, doc))
    doc, content = doc[order], content[order]
    fresh = np.r_[True, (doc[1:] != doc[:-1]) | (content[1:] != content[:-1])][: len(doc)]
    return rows[order[fresh]], values[order[fresh]]


def _met(one: _Region, two: _Region, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Entries of a region against entries of another: their windows that can be alike to one
    there, as number of the entry and place; whether one is; its place and similarity.

    Rows have the entries' places in the regions, their sizes, and the least size of a set.
    """
    base, size, smallest, other_base, other_size = rows.T
    content, held = one.windows
    first = np.searchsorted(one.places, base)
    number = np.searchsorted(one.places, base + size - WINDOW, "right") - first
    entry = np.repeat(np.arange(len(rows)), number)
    window = np.arange(len(entry)) - np.repeat(np.cumsum(number) - number - first, number)
    spot, known = one.places[window], one.known[window]
    if not one.plain:
        # A content that stands twice in an entry is looked at once.
        for k in range(len(rows)):
            run = slice(*np.searchsorted(entry, (k, k + 1)))
            stretch = content[base[k] : base[k] + size[k] - WINDOW + 1].tolist()
            lasts = dict(zip(stretch, range(base[k], base[k] + len(stretch))))
            spot[run] = [lasts[value] for value in content[spot[run]].tolist()]
    can = 4 * known >= 3 * (held[spot] + np.maximum(known, smallest[entry]) - known)
    entry, spot = entry[can], spot[can]
    plain = True if one.plain and two.plain else None
    if plain:
        same, where = one.places_in(two)
        shifts = where - np.arange(len(where))
        own = shifts[same]
        if not len(own) or (own == own[0]).all():
            first, last = other_base[entry], (other_base + other_size)[entry] - WINDOW
            place, shared = _on_one_diagonal(same, int(own[0]) if len(own) else 0, spot, first, last)
            return entry, spot, 100 * shared >= 75 * (2 * WINDOW - shared), place, shared / (2 * WINDOW - shared)
    hit, place, similarity = np.zeros(len(entry), bool), np.zeros(len(entry), np.int64), np.zeros(len(entry))
    ends = np.searchsorted(entry, np.arange(len(rows) + 1)).tolist()
    for k, (a, n, _, b, m) in enumerate(rows.tolist()):
        if ends[k] == ends[k + 1]:
            continue
        if plain:
            near = same[a : a + n] & (where[a : a + n] >= b) & (where[a : a + n] < b + m)
            if np.count_nonzero(near) < _LEAST_SHARED:
                continue
            own = shifts[a : a + n][near]
            if (own == own[0]).all():
                run = slice(ends[k], ends[k + 1])
                at, shared = _on_one_diagonal(near, int(own[0]) + a - b, spot[run] - a, 0, m - WINDOW)
                hit[run], place[run] = 100 * shared >= 75 * (2 * WINDOW - shared), at + b
                similarity[run] = shared / (2 * WINDOW - shared)
                continue
        run = np.arange(ends[k], ends[k + 1])
        run = run[np.argsort(spot[run])]
        for x, y, value in _alike(one.text[a : a + n], two.text[b : b + m], spot[run] - a, plain):
            at = run[np.searchsorted(spot[run], x + a)]
            hit[at], place[at], similarity[at] = True, y + b, value
    return entry, spot, hit, place, similarity


def _starred(rows: pa.Table, regions: pa.Table) -> pa.Table:
    """A block's entries against the first one of their centre: what is alike, and the entries
    with the windows that are still unexplained. Windows that no set of the centre can be
    alike to are not wanted any more."""
    names = ("region", "base", "shingles", "places", "known")
    held = {row[0]: _Region(*row[1:]) for row in zip(*(regions[c].to_pylist() for c in names))}
    column = {c: rows[c].to_numpy() for c in rows.column_names}
    order = np.lexsort((column["head_region"], column["region"]))
    pair = np.stack([column["region"], column["head_region"]], 1)[order]
    starts = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]).any(1)][: len(pair)])
    found, similarity, open_ = [], [], []
    for start, end in zip(starts.tolist(), np.r_[starts[1:], len(pair)].tolist()):
        run, (one, two) = order[start:end], (held[k] for k in pair[start].tolist())
        doc, other = int(column["doc"][run[0]]), int(column["head_doc"][run[0]])
        sizes = [column["base"] - one.base, column["size"], column["smallest"], column["head_base"] - two.base, column["head_size"]]
        entry, spot, hit, place, value = _met(one, two, np.stack([x[run] for x in sizes], 1).astype(np.int64))
        content = one.windows[0][spot]
        size = int(hit.sum())
        some = np.stack([np.full(size, doc), content[hit], np.full(size, other), place[hit] + two.base], 1)
        some, value = _nearest([some], [value[hit]])
        found.append(some)
        similarity.append(value)
        # What is left of an entry: its number, its document and content.
        left = ~hit
        open_.append(np.stack([run[entry[left]], np.full(int(left.sum()), doc), content[left]], 1))
    some, values = _nearest(found, similarity)
    alike = _table(_STARRED, **dict(zip(("doc", "content", "other", "place"), some.T)), similarity=values)
    left = np.concatenate([np.zeros((0, 3), np.int64), *open_])
    number, doc, content = left.T
    _, codes = np.unique(np.r_[content, some[:, 1]], return_inverse=True)
    _, docs = np.unique(np.r_[doc, some[:, 0]], return_inverse=True)
    codes = codes + docs * (int(codes.max(initial=0)) + 1)
    left = left[~np.isin(codes[: len(left)], codes[len(left) :])]
    left = left[np.argsort(left[:, 0], kind="stable")]
    number, first = np.unique(left[:, 0], return_index=True)
    wanted = pa.ListArray.from_arrays(pa.array(np.r_[first, len(left)], pa.int32()), pa.array(left[:, 2], pa.int64()))
    names = ("key", "doc", "region", "base", "size", "parts")
    rest = _table(_STARRED, wanted=wanted, **{c: column[c][number] for c in names})
    return pa.concat_tables([alike, rest])


class _Windows:
    """Wanted windows of some entries: their place among all shingles, the entry, the hash of
    their set and its size."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray, wanted: list) -> None:
        asking = np.array([x is not None for x in wanted], bool)
        owner = np.repeat(np.arange(len(starts)), ends - starts)
        sums = np.r_[np.uint64(0), np.cumsum(mixed(flat), dtype=np.uint64)]
        place = np.flatnonzero((asking & plain)[owner] & (np.arange(len(flat)) + WINDOW <= ends[owner]))
        content = sums[place + WINDOW] - sums[place]
        # A set is looked up together with its entry; a window too many would only be compared.
        salt = mixed(np.arange(1, len(starts) + 1, dtype=np.uint64))
        some = [k for k in np.flatnonzero(asking & plain).tolist() if len(wanted[k])]
        asked = np.concatenate([np.zeros(0, np.int64), *(wanted[k] for k in some)]).view(np.uint64)
        asked = asked ^ np.repeat(salt[some], [len(wanted[k]) for k in some])
        ok = np.isin(content ^ salt[owner[place]], asked)
        places, contents, least = [place[ok]], [content[ok].view(np.int64)], [np.full(int(ok.sum()), WINDOW)]
        for k in np.flatnonzero(asking & ~plain).tolist():
            content, held = _content(flat[starts[k] : ends[k]])
            # A content that stands twice in an entry is looked at once.
            lasts = dict(zip(content.tolist(), range(len(content))))
            spots = np.array([lasts[v] for v in wanted[k]], np.int64)
            places.append(starts[k] + spots)
            contents.append(content[spots])
            least.append(held[spots])
        place, content, held = (np.concatenate(x) for x in (places, contents, least))
        order = np.argsort(place, kind="stable")
        self.place, self.content = place[order], content[order]
        self.owner = owner[self.place]
        self.held = held[order]


def _tiles(rows: pa.Table) -> pa.Table:
    """Some tiles, one after the other; of each content of a document the most similar window.

    A tile has wanted windows and entries; a window meets the entries of earlier documents, the
    first ones first, until one is alike. How many of a window's shingles stand in an entry is
    counted for all windows of the tile at once, and only where they can be enough are
    they compared place by place."""
    asking = ~rows["wanted"].is_null().to_numpy()
    names = ("base", "doc", "across", "down", "key")
    base, doc, across, down, key = (rows[c].to_numpy() for c in names)
    order = np.lexsort((base, doc, asking, across, down, key))
    asking, base, doc, across, down, key = (x[order] for x in (asking, base, doc, across, down, key))
    shingles, wanted = rows["shingles"].to_pylist(), rows["wanted"].to_numpy()
    shingles, wanted = [shingles[k] for k in order.tolist()], [wanted[k] for k in order.tolist()]
    ends = np.cumsum([len(x) // 8 for x in shingles])
    starts = np.r_[0, ends[:-1]][: len(ends)]
    flat = np.frombuffer(b"".join(shingles), "<u8")
    distinct, code = np.unique(flat, return_inverse=True)
    twice = np.sort(np.repeat(np.arange(len(starts)), ends - starts) * len(distinct) + code)
    plain = np.ones(len(starts), bool)
    plain[twice[1:][twice[1:] == twice[:-1]] // max(len(distinct), 1)] = False
    windows = _Windows(flat, starts, ends, plain, wanted)
    fresh = (key[1:] != key[:-1]) | (down[1:] != down[:-1]) | (across[1:] != across[:-1])
    begins = np.flatnonzero(np.r_[True, fresh][: len(key)])
    has = np.zeros(len(distinct), bool)
    column = np.full(len(distinct), -1)
    found, similarity = [], []
    for begin, end in zip(begins.tolist(), np.r_[begins[1:], len(key)].tolist()):
        middle = begin + int(np.searchsorted(asking[begin:end], True))
        some = slice(*np.searchsorted(windows.owner, (middle, end)).tolist())
        if begin == middle or some.start == some.stop:
            continue
        place, owner, held = windows.place[some], windows.owner[some], windows.held[some]
        docs = doc[owner]
        first = int(starts[middle])
        codes, low = code[first : ends[end - 1]], place - first
        before = np.zeros(len(codes) + 1, np.int32)
        open_, top = np.ones(len(place), bool), docs.max()
        for other in range(begin, middle):
            if doc[other] >= top:
                break
            own = code[starts[other] : ends[other]]
            has[own] = True
            np.cumsum(has[codes], out=before[1:])
            has[own] = False
            shared = before[low + WINDOW] - before[low]
            near = np.flatnonzero(open_ & (docs > doc[other]) & (4 * shared >= 3 * held))
            if not len(near):
                continue
            if plain[other]:
                near = near[7 * shared[near] >= 3 * (held[near] + WINDOW)]
                if not len(near):
                    continue
            shingle, two = np.unique(own, return_inverse=True)
            sets = _sets(two, len(shingle))
            # Not even the smallest set of the entry is alike to windows that share less.
            near = near[7 * shared[near] >= 3 * (held[near] + sets.sum(1).min())]
            column[shingle] = np.arange(len(shingle))
            for run in np.split(near, range(TILE, len(near), TILE)):
                inside = np.zeros((len(run), len(shingle) + 1), np.float32)
                # What does not stand in the entry goes to the last column.
                inside[np.arange(len(run))[:, None], column[codes[low[run, None] + np.arange(WINDOW)]]] = 1
                hit, at, value = _most_alike(inside[:, :-1], sets, held[run])
                run, at = run[hit], at[hit] + base[other]
                open_[run] = False
                content = windows.content[some][run]
                found.append(np.stack([docs[run], content, np.full(len(run), doc[other]), at], 1))
                similarity.append(value[hit])
            column[shingle] = -1
            if not open_.any():
                break
            top = docs[open_].max()
    similar, values = _nearest(found, similarity)
    return _table(_FOUND, **dict(zip(("doc", "content", "other", "place"), similar.T)), similarity=values)


def _alike_contents(entries: DataFrame, regions: DataFrame, blocks: int) -> DataFrame:
    """``(doc, content, other, place, similarity)``: contents of ``entries`` that are alike to
    one of an earlier document, with one or more of these documents.

    What is exchanged of entries are their places. Their shingles come from the regions: each
    goes to a block once, and to tiles only for what is still unexplained."""
    head = F.min(F.struct("doc", "base", "region", "size")).alias("head")
    groups = entries.groupBy("key").agg(
        head, F.max("doc").alias("top"), F.count("*").alias("entries"), F.min("least").alias("smallest")
    )
    groups = groups.where("head.doc < top").select(
        "key",
        "smallest",
        F.ceil(F.col("entries") / TILE).cast("int").alias("parts"),
        *(F.col(f"head.{c}").alias(f"head_{c}") for c in ("doc", "region", "base", "size")),
    )
    later = entries.drop("least").join(groups, "key").where("doc > head_doc")
    later = written(later.withColumn("block", _block_of("doc", blocks)), cleaned=True)
    asked = later.select(F.col("block").alias("to"), F.explode(F.array("region", "head_region")).alias("region"))
    lent = asked.distinct().join(regions, "region").select("to", *_REGIONS)
    met = later.groupBy("block").cogroup(lent.groupBy("to"))
    starred = written(met.applyInArrow(_starred, _STARRED), cleaned=True)
    found = starred.where("wanted IS NULL").select(*_NEAR)
    rest = starred.where("wanted IS NOT NULL").select("key", "doc", "region", "base", "size", "parts", "wanted")
    asking = rest.groupBy("key").agg(
        F.first("parts").alias("parts"), F.ceil(F.count("*") / TILE).cast("int").alias("asking")
    )
    begins = regions.select("region", F.col("base").alias("start"), F.col("shingles").alias("whole"))
    own = F.expr("substring(whole, cast(8 * (base - start) + 1 as int), 8 * size)").alias("shingles")

    def part(number: str) -> F.Column:
        return F.pmod(F.xxhash64("doc", "base"), F.col(number).cast("long")).cast("int")

    def each(number: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    one = rest.join(asking.select("key", "asking"), "key").join(begins, "region").select(
        "key",
        "doc",
        F.lit(0).cast("long").alias("base"),
        own,
        "wanted",
        part("asking").alias("down"),
        each("parts").alias("across"),
    )
    two = entries.join(asking, "key").join(begins, "region").select(
        "key",
        "doc",
        "base",
        own,
        F.lit(None).cast("array<long>").alias("wanted"),
        each("asking").alias("down"),
        part("parts").alias("across"),
    )
    tiles = one.union(two).withColumn(
        "bucket", F.pmod(F.xxhash64("key", "down", "across"), F.lit(BUCKETS * blocks).cast("long"))
    )
    return found.union(tiles.groupBy("bucket").applyInArrow(_tiles, _FOUND))


def _reported(rows: pa.Table, found: pa.Table) -> pa.Table:
    """Runs of windows that repeat one document."""
    near: dict[tuple[int, int], tuple[float, int, int]] = {}
    for doc, content, other, place, similarity in zip(*(found[c].to_pylist() for c in _NEAR)):
        own = (-similarity, other, place)
        near[doc, content] = min(near.get((doc, content), own), own)
    out: list[list] = []
    for row in rows.to_pylist():
        docs = np.frombuffer(row["docs"], "<i8").tolist()
        runs = np.frombuffer(row["runs"], "<i8").reshape(-1, 5).tolist()
        windows = [(k, x, y, other, spot, 1.0) for k, x, y, other, spot in runs]
        if near:
            text, content = np.frombuffer(row["texts"], "<u4"), np.frombuffer(row["contents"], "<i8")
            place = np.cumsum(np.frombuffer(row["places"], "<i4"))
            ok = np.flatnonzero(np.isin(content, np.fromiter((c for _, c in near), np.int64, len(near))))
            for k, x, value in zip(text[ok].tolist(), place[ok].tolist(), content[ok].tolist()):
                if (docs[k], value) in near:
                    similarity, other, y = near[docs[k], value]
                    windows.append((k, x, x, other, y, -similarity))
        last = None
        for k, x, end, other, y, similarity in sorted(windows):
            if last == (k, x - 1, other):
                out[-1][2], out[-1][5] = end + WINDOW + SHINGLE - 1, max(out[-1][5], similarity)
            else:
                out.append([docs[k], x, end + WINDOW + SHINGLE - 1, other, y, similarity])
            last = (k, end, other)
    columns = list(zip(*out)) or [()] * 6
    names = ["doc_id", "start", "end", "other_id", "other_start", "similarity"]
    return _table(PASSAGES, **dict(zip(names, columns)))


_NEAR = ["doc", "content", "other", "place", "similarity"]
_REGIONS = ["region", "base", "shingles", "places", "known"]


def _block_of(doc: str, blocks: int) -> F.Column:
    return F.pmod(F.xxhash64(doc), F.lit(blocks).cast("long"))


def passages(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, end, other_id, other_start, similarity)``: passages of
    ``docs(doc_id, text)`` that nearly repeat one of a document with a smaller id.

    Places count words, ``end`` is exclusive, a passage has at least 50 words. Each of its
    windows of ``WINDOW`` five-word shingles has a Jaccard similarity of 0.75 or more with
    a window of the other document; ``similarity`` is the best of those found. A window is
    reported with one document, not with each earlier copy: where an earlier document has
    just its shingles, with the first such one. No exact repeat is missed; a window whose
    only alike ones have a similarity of 0.75 is missed when none of ``FUNCTIONS`` agrees,
    with probability 1.5e-5.

    Texts of fewer than 50 words, null and empty ones have no passages. Rows with the same
    ``doc_id`` are not compared with each other, rows without one not at all.
    """
    number = sharing.number_of_blocks(docs)
    rows = sharing.in_blocks(docs, number)
    blocks = rows.groupBy("block")
    asked = blocks.applyInArrow(_ask(number), sharing.ASKED)
    # One plan up to the answers, so that the texts are exchanged once for them.
    answers = asked.groupBy("shard").applyInArrow(sharing.answer, sharing.ANSWERED)
    sent = blocks.cogroup(answers.groupBy("block")).applyInArrow(_send(number), _SENT)
    first = sent.groupBy("shard").applyInArrow(_first, sharing.ANSWERED)
    answers = written(answers.union(first), cleaned=True)
    looked = blocks.cogroup(answers.groupBy("block")).applyInArrow(_looked(number), _LOOKED)
    looked = written(looked, cleaned=True)
    entries = looked.where(f"kind = {_ENTRY}").select("key", "doc", "region", "base", "size", "least")
    found = _alike_contents(entries, looked.where(f"kind = {_REGION}").select(*_REGIONS), number)
    found = found.withColumn("block", _block_of("doc", number))
    own = looked.where(f"kind = {_BLOCK}").select("block", "docs", "runs", "texts", "places", "contents")
    return own.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_reported, PASSAGES).distinct()
