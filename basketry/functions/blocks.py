"""Blocks of products of vectors, for tasks that Spark deals rows and columns to. Nothing here knows of Spark."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Entries of a sparse product that are expanded at a time, and cells of a dense one.
_ENTRIES, _CELLS = 1 << 22, 1 << 22
#: Right-hand vectors in a box, and left-hand vectors that are held against all boxes at a time.
_BOX, _ROWS = 256, 2048
#: More than what the order of a sum changes of a product, as a part of it.
_SLACK = 1e-5


def flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a column of lists without nulls."""
    chunks = lists.chunks or [pa.array([], lists.type)]
    lengths = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in chunks])
    return lengths.astype(np.int64), np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in chunks])


def starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges in a row."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - lengths), lengths)


def pieces(sizes: np.ndarray, most: int):
    """Cut a sequence so that a piece has about ``most``; one item may have more."""
    at, ends = 0, np.cumsum(sizes)
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, to
        at = to


def _added(cells: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums per cell, by cell."""
    order = np.argsort(cells, kind="stable")
    cells, values = cells[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else np.zeros(0, np.int64)
    return cells[first], np.add.reduceat(values, first) if len(cells) else values


def outer_sums(rows: tuple[np.ndarray, np.ndarray, np.ndarray], columns: tuple[np.ndarray, np.ndarray, np.ndarray]):
    """The sum of outer products: lengths, codes and values of the left and of the right vectors, one pair each.
    Returned by rows: codes of rows and of columns, where a row begins, and place of the column and value of entries."""
    (left, codes, a), (right, names, b) = rows, columns
    row_codes, row = np.unique(codes, return_inverse=True)
    column_codes, column = np.unique(names, return_inverse=True)
    of = np.repeat(np.arange(len(right)), right)
    begin, width = starts(left), max(1, len(column_codes))
    cells, values = np.zeros(0, np.int64), np.zeros(0)
    for lo, hi in pieces(left[of], _ENTRIES):
        long = left[of[lo:hi]]
        taken, own = ranges(begin[of[lo:hi]], long), np.repeat(np.arange(lo, hi), long)
        more = _added(row[taken] * width + column[own], a[taken] * b[own])
        cells, values = _added(np.concatenate([cells, more[0]]), np.concatenate([values, more[1]]))
    return row_codes, column_codes, starts(np.bincount(cells // width, minlength=len(row_codes))), cells % width, values


#: Columns of a share: the entities of some rows with their two sizes, and of each row feature, place of the entity, weight
#: and whether the feature is a heavy one.
_SHARE = (("entities", np.int64), ("wholes", np.float64), ("heavies", np.float64), ("features", np.int64), ("places", np.int32), ("weights", np.float64), ("hot", np.bool_))
SHARES = "cell int, side int, " + ", ".join(f"{name} binary" for name, _ in _SHARE)


def shares(rows: pa.Table, count: int):
    """Rows (entity, feature, weight, n, h, hot) for the cells of pairs of blocks: an entity has one of ``count`` blocks and is
    sent to the cells of this one and each, as a batch for each block."""
    entity, feature, weight, n, h, hot = (rows[c].to_numpy() for c in ("entity", "feature", "weight", "n", "h", "hot"))
    block = ((entity.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(count)).astype(np.int64)
    order = np.lexsort((feature, block))
    ends = np.searchsorted(block[order], np.arange(count + 1))
    for own in range(count):
        part = order[ends[own] : ends[own + 1]]
        if len(part):
            entities, first, place = np.unique(entity[part], return_index=True, return_inverse=True)
            values = (entities, n[part][first], h[part][first], feature[part], place, weight[part], hot[part])
            packed = [v.astype(t).tobytes() for v, (_, t) in zip(values, _SHARE, strict=True)]
            cells = pa.array([min(own, x) * count + max(own, x) for x in range(count)], pa.int32())
            sides = pa.array([int(own > x) for x in range(count)], pa.int32())
            columns = [cells, sides, *(pa.array([x] * count, pa.binary()) for x in packed)]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "side", *(name for name, _ in _SHARE)])


def _side(cell: pa.Table, side: int):
    """Entities with their two sizes; and of the rows, of light features and of heavy ones, by feature: feature, place of
    the entity and weight."""
    mine = cell.filter(pa.array(cell["side"].to_numpy() == side))
    columns = [[np.frombuffer(x, t) for x in mine[name].to_pylist()] for name, t in _SHARE]
    before = starts(np.array([len(x) for x in columns[0]], np.int64))
    columns[4] = [x + at for x, at in zip(columns[4], before, strict=False)]
    entity, whole, heavy, feature, place, weight, hot = (np.concatenate(x) if x else np.zeros(0, t) for x, (_, t) in zip(columns, _SHARE, strict=True))
    entities, first, again = np.unique(entity, return_index=True, return_inverse=True)
    rows = []
    for kind in (~hot, hot):
        order = np.flatnonzero(kind)[np.argsort(feature[kind], kind="stable")]
        rows.append((feature[order], again[place[order].astype(np.int64)], weight[order]))
    return (entities, whole[first], heavy[first]), *rows


def _light_sums(left, right) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs with a feature in common, and the sums of the products of their weights."""
    counted = [np.unique(x[0], return_counts=True) for x in (left, right)]
    _, *at = np.intersect1d(counted[0][0], counted[1][0], assume_unique=True, return_indices=True)
    vectors = []
    for (_, lengths), some, (_, place, weight) in zip(counted, at, (left, right), strict=True):
        rows = ranges(starts(lengths)[some], lengths[some])
        vectors.append((lengths[some], place[rows], weight[rows]))
    row, column, begin, where, dot = outer_sums(*vectors)
    return np.repeat(row, np.diff(begin)), column[where], dot


def _hot_pairs(left, right, share: tuple[np.ndarray, np.ndarray], least: float) -> np.ndarray:
    """Places of the pairs, as one number, with a heavy feature in common whose shares have a product of ``least``."""
    (feature, place, _), (other, theirs, _) = left, right
    names, at = np.unique(feature, return_inverse=True)
    # By feature, great shares first.
    key = 2.0 * at + 1.0 - share[0][place]
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    met = np.minimum(np.searchsorted(names, other), max(0, len(names) - 1))
    able = (names[met] == other) & (share[1][theirs] >= least) if len(names) else np.zeros(len(other), bool)
    met, theirs = met[able], theirs[able]
    need = np.minimum(1.0, least / share[1][theirs])
    first, last = np.searchsorted(key, 2.0 * met - 0.5), np.searchsorted(key, 2.0 * met + 1.0 - need + 1e-9, "right")
    found, width = [np.zeros(0, np.int64)], len(share[1])
    for lo, hi in pieces(last - first, _ENTRIES):
        long = last[lo:hi] - first[lo:hi]
        found.append(np.unique(place[ranges(first[lo:hi], long)] * width + np.repeat(theirs[lo:hi], long)))
    return np.unique(np.concatenate(found))


def _hot_sums(left, right, p: np.ndarray, q: np.ndarray, counts: tuple[int, int]) -> np.ndarray:
    """For pairs by their places the sum of the products of their weights over heavy features."""
    names = np.unique(right[0])
    if not len(names) or not len(left[0]):
        return np.zeros(len(p))
    at = np.minimum(np.searchsorted(names, left[0]), len(names) - 1)
    shared = np.flatnonzero(names[at] == left[0])
    shared = shared[np.argsort(left[1][shared], kind="stable")]
    lengths = np.bincount(left[1][shared], minlength=counts[0])
    begin = starts(lengths)
    key = right[1].astype(np.int64) * len(names) + np.searchsorted(names, right[0])
    order = np.argsort(key)
    key, weight = key[order], right[2][order]
    sums = np.zeros(len(p))
    for lo, hi in pieces(lengths[p] + 1, _ENTRIES):
        long = lengths[p[lo:hi]]
        rows = shared[ranges(begin[p[lo:hi]], long)]
        of = np.repeat(np.arange(hi - lo), long)
        wanted = q[lo:hi][of] * len(names) + at[rows]
        place = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        sums[lo:hi] = np.bincount(of, np.where(key[place] == wanted, left[2][rows] * weight[place], 0.0), hi - lo)
    return sums


def pair_sums(cell: pa.Table, count: int, able, least: float | None) -> pa.Table:
    """Of the shares of a cell the pairs ``a < b`` that are ``able``: the sum of the products of their weights, and the
    sizes of both.

    Pairs of a light feature are all formed. With ``least`` the rows of heavy features are there too: pairs of these are
    formed where the shares that heavy features have of the two vectors have a product of ``least``, and what they add
    is summed for those pairs only that are able with the most they may add."""
    number = cell["cell"][0].as_py()
    alike = number // count == number % count
    left = _side(cell, 0)
    right = left if alike else _side(cell, 1)
    p, q, dot = _light_sums(left[1], right[1])
    sizes = [lambda p, q, k=k: (left[0][k][p], right[0][k][q]) for k in (1, 2)]
    kept = able(dot, *sizes[0](p, q), *sizes[1](p, q))
    p, q, dot = p[kept], q[kept], dot[kept]
    if least is not None and len(left[2][0]) and len(right[2][0]):
        width = len(right[0][0])
        light = p * width + q
        share = tuple(np.divide(x[0][2], x[0][1], out=np.zeros(len(x[0][1])), where=x[0][1] > 0) for x in (left, right))
        more = np.setdiff1d(_hot_pairs(left[2], right[2], share, least), light)
        # Those of them that have a light feature in common are able, so they are there already.
        p, q, dot = np.append(p, more // width), np.append(q, more % width), np.append(dot, np.zeros(len(more)))
        dot = dot + _hot_sums(left[2], right[2], p, q, (len(left[0][0]), width))
    a, b = left[0][0][p], right[0][0][q]
    most = sizes[1](p, q) if least is None else (np.zeros(len(p)), np.zeros(len(p)))
    kept = able(dot, *sizes[0](p, q), *most) & (a < b if alike else a != b)
    p, q, a, b, dot = p[kept], q[kept], a[kept], b[kept], dot[kept]
    turned = a > b
    (na, nb), (ha, hb) = ((np.where(turned, v, u), np.where(turned, u, v)) for u, v in (sizes[0](p, q), sizes[1](p, q)))
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "dot": dot, "na": na, "nb": nb, "ha": ha, "hb": hb})


def best_of_sparse(people, matrix, n: int, unit: float):
    """Of the products of sparse vectors with ``matrix``: place of the vector, code of the column and value of all that
    can be among the ``n`` greatest when values are rounded to ``unit`` and ties go by code. Columns whose code the
    vector has itself, and columns without a product, do not count."""
    lengths, codes, units = people
    row_codes, column_codes, begin, column, value = matrix
    width = len(column_codes)
    if not width or not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.minimum(np.searchsorted(column_codes, codes), width - 1)
    own = column_codes[place] == codes
    own_at, own_column = owner[own], place[own]
    row = np.minimum(np.searchsorted(row_codes, codes), len(row_codes) - 1)
    met = row_codes[row] == codes
    owner, units, row = owner[met], units[met], row[met]
    long = begin[row + 1] - begin[row]
    work = np.bincount(owner, weights=long, minlength=len(lengths)) + width * (_ENTRIES / _CELLS)
    entry, bought = starts(np.bincount(owner, minlength=len(lengths))), starts(np.bincount(own_at, minlength=len(lengths)))
    found = []
    for lo, hi in pieces(work, _ENTRIES):
        part = slice(entry[lo], entry[hi])
        taken = ranges(begin[row[part]], long[part])
        cells = np.repeat((owner[part] - lo) * width, long[part]) + column[taken]
        sums = np.bincount(cells, np.repeat(units[part], long[part]) * value[taken], (hi - lo) * width).reshape(hi - lo, width)
        mine = slice(bought[lo], bought[hi])
        sums[own_at[mine] - lo, own_column[mine]] = 0.0
        # What may round to the n-th value or to more; of values that are surely equal the first n are enough.
        least = np.partition(sums, width - n, axis=1)[:, width - n] if width > n else np.zeros(hi - lo)
        at, where = np.nonzero((sums > 0) & (sums >= (least - unit)[:, None]))
        score = sums[at, where]
        low, high = np.floor(score / unit + 0.5 - 1e-3), np.floor(score / unit + 0.5 + 1e-3)
        sure = low == high
        order = np.lexsort((where, -low, at, ~sure))
        at, where, score, low, sure = at[order], where[order], score[order], low[order], sure[order]
        fresh = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (low[1:] != low[:-1]) | (sure[1:] != sure[:-1])])) if len(at) else np.zeros(0, np.int64)
        nth = np.arange(len(at)) - np.repeat(fresh, np.diff(np.append(fresh, len(at))))
        kept = ~sure | (nth < n)
        found.append((at[kept] + lo, column_codes[where[kept]], score[kept]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _boxes(vectors: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of the vectors in boxes: halved at the median of the widest side until a box has few."""
    waiting, done = [np.arange(len(vectors))], []
    while waiting:
        places = waiting.pop()
        if len(places) <= most:
            done.append(places)
            continue
        inside = vectors[places]
        side = np.argmax(inside.max(axis=0) - inside.min(axis=0))
        order = np.argpartition(inside[:, side], len(places) // 2)
        waiting += [places[order[: len(places) // 2]], places[order[len(places) // 2 :]]]
    return done


def best_of_dense(left: np.ndarray, right: np.ndarray, names: np.ndarray, n: int):
    """For every left vector the ``n`` right ones with the greatest product: place, name and value; ties go by name.

    Right vectors lie in boxes. No product with a vector of a box is greater than that with its best corner, so a box is
    computed for those left vectors only whose n-th value this corner reaches; like left vectors go together."""
    boxes = _boxes(right, _BOX)
    top, bottom = (np.stack([f(right[b], axis=0) for b in boxes]) for f in (np.max, np.min))
    far = np.maximum(np.abs(top), np.abs(bottom))
    found = []
    for group in _boxes(left, _ROWS):
        x = left[group]
        # More than what rounding may add to a product.
        bound = np.maximum(x, 0) @ top.T + np.minimum(x, 0) @ bottom.T + 1e-5 * (np.abs(x) @ far.T)
        best = np.full((len(x), n), np.finfo(x.dtype).min / 2, x.dtype)
        kept = []
        for b in np.argsort(-bound.mean(axis=0)):
            able = np.flatnonzero(bound[:, b] >= best[:, 0])
            if not len(able):
                continue
            score = x[able] @ right[boxes[b]].T
            enough = score >= (best[able, :1] - _SLACK * np.abs(best[able, :1]))
            some = np.flatnonzero(enough.any(axis=1))
            able, score, enough = able[some], score[some], enough[some]
            at, where = np.nonzero(enough)
            kept.append((able[at], boxes[b][where], score[at, where]))
            best[able] = np.sort(np.partition(np.concatenate([best[able], score], axis=1), -n, axis=1)[:, -n:], axis=1)
        at, place, score = (np.concatenate(c) for c in zip(*kept, strict=True))
        near = score >= best[at, 0] - _SLACK * np.abs(best[at, 0])
        at, place = at[near], place[near]
        # Summed in one order, however the vectors lie in boxes.
        score, who = np.zeros(len(at), x.dtype), names[place]
        for side in range(x.shape[1]):
            score += x[at, side] * right[place, side]
        score = score.astype(np.float64)
        order = np.lexsort((who, -score, at))
        at, who, score = at[order], who[order], score[order]
        nth = np.arange(len(at)) - np.searchsorted(at, at)
        found.append((group[at[nth < n]], who[nth < n], score[nth < n]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))
