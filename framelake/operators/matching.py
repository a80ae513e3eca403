"""Greedy matching of boxes. Within images, many small groups of a sorted stream are compared at once over Arrow columns. Across images, each pool is one
sorted stream past an index of its truths that are still free. Pairs are never stored."""

from __future__ import annotations

import copy
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ranges

#: Predictions that look at the index together, the most entries or cells that they look at together (one prediction may pass it), and the most pairs within images.
BLOCK, LOOKED, PAIRS = 512, 1 << 17, 1 << 20
#: Levels of IoU at which a prediction's truth is sought: each is STEP times as far from 1 as the one below it, the highest about FINEST. Predictions of a size begin near
#: BEGIN and go up a level when they see more than MANY entries each; a level with fewer than SPARE free truths does not do. FEW entries or less are sought at the threshold.
STEP, FINEST, BEGIN, SPARE, MANY, FEW = 0.7, 0.001, 0.05, 2, 8, 2048


def _index_class():
    """The class is made in a function, so that it travels to the tasks by value."""
    import numpy as np

    # memory that is used again: fresh arrays cost more than the work on them
    count, ints, floats = np.empty(0, int), [], []

    def buffers(size):
        """Four arrays of integers and five of floats with ``size`` places, and one of floats with as many places as there are."""
        nonlocal count, ints, floats
        if not len(count) or size > len(count):
            count = np.arange(max(size, LOOKED))
            ints, floats = [np.empty(len(count), int) for _ in range(4)], [np.empty(len(count)) for _ in range(6)]
        return [x[:size] for x in ints], [x[:size] for x in floats[:5]], floats[5]

    def gather(values, places, out):
        return values.take(places, out=out, mode="clip")

    def numbered(ends, out):
        """The number of its group for each place; no group is empty."""
        out[:] = 0
        out[ends[:-1]] = 1
        out.cumsum(out=out)

    class Index:
        """The free truths of a pool at one threshold. Truths of equal boxes are one entry, whose smallest free id is given out first.

        With an IoU above v the intervals of both axes have an overlap above v of their union, so a truth's left edge lies within w(1/v - 1) before and
        w(1 - v) after the prediction's, its width between wv and w/v, and its top edge and height likewise: entries lie in cells by height, width, top and
        left edge. The best truth is sought among those above a high IoU first, then above lower ones, down to the threshold.
        """

        def __init__(self, boxes, threshold):
            order = np.lexsort(boxes.T[::-1])  # stable: ids of equal boxes stay in their order
            new = np.ones(len(boxes), bool)
            new[1:] = (boxes[order[1:]] != boxes[order[:-1]]).any(axis=1)
            starts = np.flatnonzero(new)
            self.boxes, self.ranks = boxes[order[starts]], order.tolist()
            self.areas = (self.boxes[:, 2] - self.boxes[:, 0]) * (self.boxes[:, 3] - self.boxes[:, 1])
            self.begin(starts, np.diff(np.append(starts, len(boxes))), threshold)

        def begin(self, starts, sizes, threshold):
            # levels above which entries are sought, the threshold last
            steps = range(1 + max(0, int(np.log(FINEST / (1 - threshold)) / np.log(STEP)))) if threshold < 1 else range(1)
            self.levels = [threshold if not n else 1 - (1 - threshold) * STEP**n for n in reversed(steps)]
            # the level to begin with, by the size of a prediction
            self.first = np.full(64, min(sum(v > 1 - BEGIN for v in self.levels), len(self.levels) - 1))
            self.starts, self.next, self.free, self.left = starts, starts.tolist(), sizes, len(sizes)
            self.build()

        def at(self, threshold):
            """An index of the same truths, all free, at another threshold."""
            other = copy.copy(self)
            other.begin(self.starts, np.diff(np.append(self.starts, len(self.ranks))), threshold)
            return other

        def build(self):
            own = np.flatnonzero(self.free)
            self.indexed = len(own)
            box = self.boxes[own]
            x, y, w, h = box[:, 0], box[:, 1], box[:, 2] - box[:, 0], box[:, 3] - box[:, 1]

            def cells(values, most):
                if most < 2:
                    return np.empty(0)
                ordered = np.sort(values)
                return np.unique(ordered[len(own) * np.arange(1, most) // most])

            side = min(16, int(len(own) ** 0.25))
            self.h, self.w, self.y = (cells(v, side) for v in (h, w, y))
            rows = (len(self.h) + 1) * (len(self.w) + 1) * (len(self.y) + 1)
            self.x = cells(x, min(1024, 1 + 2 * len(own) // rows))
            place = np.searchsorted(self.h, h, "right")
            for edges, values in ((self.w, w), (self.y, y), (self.x, x)):
                place = place * (len(edges) + 1) + np.searchsorted(edges, values, "right")
            self.ends = np.append(0, np.cumsum(np.bincount(place, minlength=rows * (len(self.x) + 1))))
            order = np.argsort(place, kind="stable")
            self.own = own[order]
            self.columns = [np.ascontiguousarray(box[order, c]) for c in range(4)]

        def cells(self, p, v):
            """For each prediction the first and last cell of every side in which truths with an IoU above v lie."""
            before, after = 1 / v - 1, 1 - v
            w, h = p[:, 2] - p[:, 0], p[:, 3] - p[:, 1]
            slack = 1e-9 * (1 + np.abs(p).max(axis=1))
            bounds = (self.h, h * v, h / v), (self.w, w * v, w / v), (self.y, p[:, 1] - h * before, p[:, 1] + h * after), (self.x, p[:, 0] - w * before, p[:, 0] + w * after)
            return [(edges.searchsorted(low - slack, "right"), edges.searchsorted(high + slack, "right")) for edges, low, high in bounds]

        def spans(self, cells, n):
            """(prediction, from, number): the ranges of entries in the cells, without empty ones."""
            (h, _), (w0, w1), (y0, y1), (x0, x1) = cells
            ends = n.cumsum()
            (who, rest, other, place), _, _ = buffers(ends[-1])
            numbered(ends, who)
            y, w, x = len(self.y) + 1, len(self.w) + 1, len(self.x) + 1
            np.subtract(count[: len(who)], gather(ends - n, who, rest), out=rest)
            np.divmod(rest, gather(y1 - y0 + 1, who, other), out=(rest, place))  # the cell's number by top edge, then by width, then by height
            np.divmod(rest, gather(w1 - w0 + 1, who, other), out=(rest, other))
            rest *= w
            rest += other
            rest *= y
            rest += place
            rest *= x
            rest += gather(((h * w + w0) * y + y0) * x, who, other)
            start = gather(self.ends, np.add(rest, gather(x0, who, other), out=place), other)
            rest += gather(x1 + 1, who, place)
            size = np.subtract(gather(self.ends, rest, place), start, out=place)
            some = size.nonzero()[0]
            return who[some], start[some], size[some]

        def hits(self, p, who, start, n, level):
            """(prediction, IoU, entry) of the free entries above a level."""
            if not len(n):
                return who, np.empty(0), who
            ends = n.cumsum()
            (span, at, e, _), (a, b, c, d, v), more = buffers(ends[-1])
            numbered(ends, span)
            gather(who, span, at)
            gather(start - (ends - n), span, e)
            e += count[: len(e)]
            x1, y1, x2, y2 = np.ascontiguousarray(p.T)

            def axis(side, low, high, at, e):
                """Length of what the intervals share, and of what they span."""
                a0, a2, b0, b2, over = (x[: len(at)] for x in (a, b, c, d, v))
                gather(low, at, a0), gather(high, at, a2), gather(self.columns[side], e, b0), gather(self.columns[side + 2], e, b2)
                np.minimum(a2, b2, out=over)
                over -= np.maximum(a0, b0, out=more[: len(at)])
                np.maximum(a2, b2, out=a2)
                a2 -= np.minimum(a0, b0, out=a0)
                return over, a2

            # an axis at a time: most entries of a range fail on the first
            over, whole = axis(0, x1, x2, at, e)
            whole *= level * (1 - 1e-6)
            near = (over > whole).nonzero()[0]
            at, e, wide = at[near], e[near], over[near]
            tall, whole = axis(1, y1, y2, at, e)
            whole *= level * (1 - 1e-6)
            near = (tall > whole).nonzero()[0]
            at, e, wide, tall = at[near], self.own[e[near]], wide[near], tall[near]
            both = np.maximum(wide, 0.0) * np.maximum(tall, 0.0)
            union = ((x2 - x1) * (y2 - y1))[at] + self.areas[e] - both
            iou = np.divide(both, union, out=np.zeros(len(both)), where=union > 0)
            good = ((iou > level) & (self.free[e] > 0)).nonzero()[0]
            return at[good], iou[good], e[good]

        def near(self, p, first, enough):
            """(prediction, IoU, entry) of the free entries above each prediction's own level, best first, and that level's number: from its ``first`` the first with ``enough`` free truths."""
            found, own, rows, begins = [], np.full(len(p), len(self.levels) - 1), np.empty(0, int), np.bincount(first, minlength=len(self.levels))
            for number, level in enumerate(self.levels):
                if begins[number]:
                    rows = np.append(rows, np.flatnonzero(first == number))
                if not len(rows):
                    continue
                done, short = 0, []
                cells = self.cells(p[rows], level)
                n = reduce(lambda a, b: a * b, [to - start + 1 for start, to in cells[:3]])
                ends = n.cumsum()
                while done < len(rows):
                    to = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + LOOKED, "right")))
                    mine = rows[done:to]
                    who, start, size = self.spans([(a[done:to], b[done:to]) for a, b in cells], n[done:to])
                    seen = np.cumsum(np.bincount(who, weights=size, minlength=len(mine)))
                    take = max(1, int(np.searchsorted(seen, LOOKED, "right")))
                    if take < len(mine):
                        last = np.searchsorted(who, take)
                        who, start, size, mine = who[:last], start[:last], size[:last], mine[:take]
                    at, v, e = self.hits(p[mine], who, start, size, level)
                    if number < len(self.levels) - 1:
                        full = np.bincount(at, weights=self.free[e], minlength=len(mine)) >= enough
                        own[mine[full]] = number
                        short.append(mine[~full])
                        kept = full[at]
                        at, v, e = at[kept], v[kept], e[kept]
                    found.append((mine[at], v, e))
                    done += len(mine)
                rows = np.concatenate(short) if short else rows[:0]
            at, v, e = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((-v, at))
            return at[order], v[order], e[order], own

        def match(self, p):
            """Ranks of the truths that the boxes take in turn, -1 for none."""
            out = np.full(len(p), -1)
            for done in range(0, len(p), BLOCK):
                if not self.left:
                    break
                if self.left * 2 < self.indexed:
                    self.build()
                block = p[done : done + BLOCK]
                size = np.frexp((block[:, 2] - block[:, 0]) * (block[:, 3] - block[:, 1]))[1] % 64
                first = self.first[size] if self.left > FEW else np.full(len(block), len(self.levels) - 1)
                at, v, e, own = self.near(block, first, SPARE)
                self.take(out[done : done + BLOCK], block, at.tolist(), v.tolist(), e.tolist(), own.tolist())
                if self.left <= FEW:
                    continue
                # the first level should neither list many entries nor find too few
                asked, listed, short = (np.bincount(size, weights=x, minlength=64) for x in (None, np.bincount(at, minlength=len(block)), own > first))
                self.first += (2 * short > asked).astype(int) - ((listed > MANY * asked) & (2 * short <= asked) & (self.first > 0))
            return out

        def take(self, out, block, at, v, e, own):
            ranks, following, free = self.ranks, self.next, self.free
            i, size, last = 0, len(at), len(self.levels) - 1
            for a, level in enumerate(own):
                best, value = None, None
                while i < size and at[i] == a:
                    if best is not None and v[i] != value:
                        i += 1
                        continue
                    c = e[i]
                    if free[c] and (best is None or ranks[following[c]] < ranks[following[best]]):
                        best, value = c, v[i]
                    i += 1
                if best is None and level < last:  # those before it have taken all that it was shown
                    _, values, entries, _ = self.near(block[a : a + 1], np.array([last]), 1)
                    if len(entries):
                        best = min(entries[values == values[0]].tolist(), key=lambda c: ranks[following[c]])
                if best is None:
                    continue
                out[a] = ranks[following[best]]
                following[best] += 1
                free[best] -= 1
                if not free[best]:
                    self.left -= 1

    return Index


def _streamed(group: list[str], thresholds: list[float]):
    """For rows sorted by group, truths by id before predictions by order: the predictions with the truths that they take at each threshold."""

    def rows(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        Index, last, ids, held, indexes = _index_class(), None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = ranges.changed(batch, group, last)
            last = [batch.column(c)[-1].as_py() for c in group]
            starts = np.flatnonzero(new | (np.arange(len(new)) == 0)).tolist()
            kinds = batch.column("kind").to_numpy()
            box = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("x1", "y1", "x2", "y2")], axis=1).astype(float)
            null = np.zeros(len(new), bool)  # null keys match nothing
            for c in group:
                null |= batch.column(c).is_null().to_numpy(zero_copy_only=False)
            # boxes without an area or a corner match nothing
            proper = np.isfinite(box).all(axis=1) & (box[:, 2] > box[:, 0]) & (box[:, 3] > box[:, 1])
            kind = batch.schema.field("truth_id").type
            wide = pa.large_string() if pa.types.is_string(kind) else kind  # ids of a pool may pass the size of a small array
            truths = [[] for _ in thresholds]
            for i, j in zip(starts, [*starts[1:], len(new)]):
                if new[i]:
                    ids, held, indexes = [], [], None
                m = i + int(np.searchsorted(kinds[i:j], 1))
                if m > i and not null[i]:
                    ids.append(batch.column("truth_id").slice(i, m - i).cast(wide))
                    held.append(box[i:m])
                if m == j:
                    continue
                if not ids:
                    for out in truths:
                        out.append(pa.nulls(j - m, wide))
                    continue
                if indexes is None:
                    every = np.concatenate(held)
                    index = Index(every, thresholds[0])
                    indexes, ids, held = [index, *(index.at(t) for t in thresholds[1:])], [pa.concat_arrays(ids)], []
                asked = np.flatnonzero(proper[m:j])
                for index, out in zip(indexes, truths):
                    found = np.full(j - m, -1)
                    found[asked] = index.match(box[m:j][asked])
                    out.append(ids[0].take(pa.array(found, mask=found < 0)))
            own = pa.array(np.flatnonzero(kinds == 1))
            if not len(own):
                continue
            columns = {c: batch.column(c).take(own) for c in [*group, "prediction_id", "confidence"]}
            for t, out in zip(thresholds, truths):
                columns |= {"threshold": pa.array(np.full(len(own), t)), "truth_id": pa.concat_arrays(out).cast(kind)}
                yield pa.RecordBatch.from_pydict({c: columns[c] for c in [*group, "threshold", "prediction_id", "confidence", "truth_id"]})

    return rows


def _within(group: list[str], thresholds: list[float]):
    """For rows sorted by group, truths by id before predictions by order: the predictions with the truths that they take at each threshold. A group is held whole, its
    pairs are compared in parts."""

    def matched(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table = pa.Table.from_batches(batches).combine_chunks()
        kind = table.column("kind").to_numpy()
        asked, held = np.flatnonzero(kind == 1), np.flatnonzero(kind == 0)
        number = np.cumsum(ranges.changed(table, group)) - 1
        # truths with one id are one
        slots = np.cumsum(ranges.changed(table.select([*group, "truth_id"]), [*group, "truth_id"]))
        box = np.stack([table.column(c).to_numpy() for c in ("x1", "y1", "x2", "y2")], axis=1).astype(float)
        proper = np.isfinite(box).all(axis=1) & (box[:, 2] > box[:, 0]) & (box[:, 3] > box[:, 1])
        area = (box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1])
        sizes = np.bincount(number[held], minlength=number[-1] + 1)
        first = np.searchsorted(number[held], np.arange(len(sizes)))
        n = np.where(proper[asked], sizes[number[asked]], 0)
        ends = np.cumsum(n)
        taken = [bytearray(int(slots[-1]) + 1) for _ in thresholds]
        found = [np.full(len(asked), -1) for _ in thresholds]
        done = 0
        while done < len(asked):
            start = ends[done - 1] if done else 0
            to = max(done + 1, int(np.searchsorted(ends, start + PAIRS, "right")))
            own = np.repeat(np.arange(done, to), n[done:to])
            place = np.arange(len(own)) - np.repeat(ends[done:to] - n[done:to] - start, n[done:to])
            t, p = held[first[number[asked[own]]] + place], asked[own]
            wide = np.minimum(box[p, 2], box[t, 2]) - np.maximum(box[p, 0], box[t, 0])
            tall = np.minimum(box[p, 3], box[t, 3]) - np.maximum(box[p, 1], box[t, 1])
            both = np.maximum(wide, 0.0) * np.maximum(tall, 0.0)
            union = area[p] + area[t] - both
            v = np.divide(both, union, out=np.zeros(len(both)), where=union > 0)
            good = v > min(thresholds)
            own, t, v = own[good], t[good], v[good]
            order = np.lexsort((-v, own))
            own, t, v = own[order], t[order], v[order]
            for k, threshold in enumerate(thresholds):
                enough = v > threshold
                full, out, last = taken[k], found[k], -1
                for i, j, slot in zip(own[enough].tolist(), t[enough].tolist(), slots[t[enough]].tolist()):
                    if i != last and not full[slot]:
                        full[slot], out[i], last = 1, j, i
            done = to
        rows = table.take(pa.array(asked))
        ids = table.column("truth_id")
        for threshold, out in zip(thresholds, found):
            columns = {c: rows.column(c) for c in group} | {"threshold": pa.array(np.full(len(asked), threshold))}
            columns |= {"prediction_id": rows.column("prediction_id"), "confidence": rows.column("confidence"), "truth_id": ids.take(pa.array(out, mask=out < 0))}
            yield from pa.table(columns).combine_chunks().to_batches()

    def rows(batches) -> Iterator:
        import numpy as np

        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.flatnonzero(ranges.changed(batch, group, last))
            if len(starts):  # the last group may go on
                if starts[-1]:
                    held.append(batch.slice(0, starts[-1]))
                if held:
                    yield from matched(held)
                held = []
            held.append(batch.slice(starts[-1] if len(starts) else 0))
            last = [batch.column(c)[-1].as_py() for c in group]
        if held:
            yield from matched(held)

    return rows


def within(predictions: DataFrame, truths: DataFrame, thresholds, keys=("candidate",), scope: str = "image_id") -> DataFrame:
    """Greedy matching per class and threshold within the images of a key: predictions by confidence and id, each takes the free truth with the highest IoU
    strictly above the threshold; ties go to the smaller truth_id. Returns keys, scope, label, threshold, prediction_id, confidence, truth_id.

    One shuffle brings the boxes of an image and class together; a task holds those of one such group and what came in a batch with them. Boxes without an area
    or a corner and null keys match nothing. Thresholds are positive.
    """
    group = [*keys, scope, "label"]
    rows, schema = _met(predictions, truths.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in group])), group, [scope, "label", *keys])
    return rows.mapInArrow(_within(group, [float(x) for x in thresholds]), schema)


def _met(predictions: DataFrame, truths: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, str]:
    """(truths and predictions by group, truths by id before predictions by confidence and id, the schema of matches). Truths without an area or a corner are left out."""
    kinds = {f.name: f.dataType.simpleString() for f in predictions.schema.fields} | {"truth_id": truths.schema["truth_id"].dataType.simpleString(), "threshold": "double"}
    corners = [F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]
    absent = lambda n: F.lit(None).cast(kinds[n]).alias(n)
    proper = (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
    for c in ("x1", "y1", "x2", "y2"):
        proper &= F.abs(F.col(c)) < F.lit(float("inf"))
    held = truths.where(proper).select(*group, F.lit(0).alias("kind"), absent("prediction_id"), absent("confidence"), "truth_id", *corners)
    asked = predictions.select(*group, F.lit(1).alias("kind"), "prediction_id", "confidence", absent("truth_id"), *corners)
    # a number is given, or Spark would join the few bytes of many pools in one task
    parts = int(predictions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = held.union(asked).repartition(parts, *group).sortWithinPartitions(*order, "kind", -F.col("confidence"), "prediction_id", "truth_id")
    names = [*group, "threshold", "prediction_id", "confidence", "truth_id"]
    return rows, ", ".join(f"`{c}` {kinds[c]}" for c in names)


def pooled(predictions: DataFrame, truths: DataFrame, thresholds, keys=("candidate",)) -> DataFrame:
    """Greedy matching per class and threshold over all images of a key: predictions by confidence and id, each takes the free truth with the highest IoU
    strictly above the threshold; ties go to the smaller truth_id. Returns keys, label, threshold, prediction_id, confidence, truth_id.

    One shuffle brings a pool (key and class) together, its truths first; its predictions stream past an index of the free truths, so a task holds the truths
    of one pool and no table of pairs is made, whose size is the product of a pool's predictions and truths. A taken truth leaves the index. A pool is one
    task. Keys and labels are not null; ids are unique within a key; thresholds are positive.
    """
    group = [*keys, "label"]
    rows, schema = _met(predictions, truths, group, group)
    return rows.mapInArrow(_streamed(group, [float(x) for x in thresholds]), schema)
