"""Least squares trees with numpy, grown on every row of a bag, whatever their number.

A node of at most ``held`` drawn rows is grown in memory, level by level. A larger one is cut first: its rows, in the order
of each feature, are read piece by piece from columns on disk. All cuts are compared either way, so memory is bounded and
nothing is left out. The functions made here carry all they need to the executors.
"""

from __future__ import annotations

#: Rows that pass a tree together, so that what a step needs of them stays in the processor's cache.
_WALKED = 8_192


def tree_maker(min_leaf: int, max_depth: int | None):
    """``tree_of``: the tree of rows in memory as arrays of feature, threshold, left child and value per node."""

    def tree_of(x, y, w, tiny=None, levels=max_depth):
        """``x`` has a line per feature (single), ``w`` the draws of a row, all above 0. A leaf leads to itself."""
        import numpy as np

        n = x.shape[1]
        centre = np.average(y, weights=w)
        y = y - centre
        wy = w * y
        tiny = 1e-12 * (wy @ y) if tiny is None else tiny
        most = max(1, 2 * (n // min_leaf))
        feature, threshold = np.zeros(most, dtype=np.int32), np.full(most, np.inf)
        left, value = np.arange(most, dtype=np.int32), np.full(most, centre)
        # rows by node, then by the feature; a constant feature, or one that orders rows as one before it does, is never chosen
        order, rising, used = [], [], []
        for f in range(len(x)):
            bits = x[f].view(np.uint32)
            keys = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
            sort = np.sort(keys << np.uint64(32) | np.arange(n, dtype=np.uint64))
            own = (sort & np.uint64(0xFFFFFFFF)).astype(np.int32)
            steps = np.diff(sort >> np.uint64(32)) > 0
            if steps.any() and not any(np.array_equal(steps, s) and np.array_equal(own, o) for s, o in zip(rising, order)):
                order.append(own)
                rising.append(steps)
                used.append(f)
        del rising
        used = np.array(used, dtype=np.int64)
        sizes, nodes, count, depth = np.array([n]), np.array([0]), 1, 0
        while len(used) and len(sizes) and (levels is None or depth < levels):
            depth += 1
            ends = np.cumsum(sizes)
            starts, m = ends - sizes, int(ends[-1])
            segment = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            place = np.arange(1, m + 1) - np.repeat(starts, sizes)
            fits = ((place >= min_leaf) & (place <= np.repeat(sizes - min_leaf, sizes)))[:-1]
            # sums of a node start from its own mean: the gain of a cut is then one quotient
            held, draws = order[0], w[order[0]]
            whole = np.add.reduceat(draws, starts)
            middle = np.add.reduceat(draws * y[held], starts) / whole
            wy[held] = draws * (y[held] - np.repeat(middle, sizes))
            all_w, base_w = np.repeat(whole, sizes), np.repeat(np.cumsum(whole) - whole, sizes)
            best, gains, sides = np.full((len(used), len(sizes)), -np.inf), [], []
            for f, own in enumerate(order):
                xs = x[used[f]][own]
                may = np.append(fits & (xs[:-1] < xs[1:]), False)
                cw, cs = np.cumsum(w[own]), np.cumsum(wy[own])
                base_s = np.where(starts > 0, cs[starts - 1], 0.0)
                if 3 * np.count_nonzero(may) > m:
                    lw, ls = cw - base_w, cs - np.repeat(base_s, sizes)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        gain = np.where(may, ls * ls * all_w / (lw * (all_w - lw)), -np.inf)
                else:
                    at = np.flatnonzero(may)
                    lw, ls = cw[at] - base_w[at], cs[at] - base_s[segment[at]]
                    gain = np.full(m, -np.inf)
                    gain[at] = ls * ls * all_w[at] / (lw * (all_w[at] - lw))
                best[f] = np.maximum.reduceat(gain, starts)
                gains.append(gain)
                sides.append((cw, cs, base_s))
            top = best.max(axis=0)
            enough, split = top * (1 - 1e-9), top > tiny
            if not split.any():
                break
            which = np.where(split, np.argmax(best >= enough, axis=0), -1)
            cut, low, high, below, above = (np.zeros(len(sizes), dtype=t) for t in (np.int64, float, float, float, float))
            number = np.cumsum(split) - 1  # of split nodes: their place among these
            goes = np.full(n, -1, dtype=np.int32)
            for f in np.unique(which[split]).tolist():
                mine, own, xs, (cw, cs, base_s) = which == f, order[f], x[used[f]], sides[f]
                good = np.flatnonzero(np.repeat(mine, sizes) & (gains[f] >= np.repeat(enough, sizes)))
                of = segment[good]
                first = np.append(True, of[1:] != of[:-1])  # the smallest threshold
                at, of = good[first], of[first]
                cut[of], low[of], high[of] = at, xs[own[at]], xs[own[at + 1]]
                lw, ls = cw[at] - base_w[at], cs[at] - base_s[of]
                below[of], above[of] = middle[of] + ls / lw, middle[of] - ls / (whole[of] - lw)
                inside = np.flatnonzero(np.repeat(mine, sizes))
                goes[own[inside]] = 2 * number[segment[inside]] + (inside > cut[segment[inside]])
            del gains, sides
            chosen = np.flatnonzero(split)
            children = count + 2 * np.arange(len(chosen))
            feature[nodes[chosen]] = used[which[chosen]]
            threshold[nodes[chosen]] = low[chosen] + (high[chosen] - low[chosen]) / 2
            left[nodes[chosen]] = children
            value[children], value[children + 1] = below[chosen] + centre, above[chosen] + centre
            sizes = np.column_stack([cut[chosen] - starts[chosen] + 1, ends[chosen] - cut[chosen] - 1]).ravel()
            nodes = count + np.arange(2 * len(chosen))
            count += 2 * len(chosen)
            # rows of nodes that may be cut again go on, grouped by node, each feature still in its order
            on = sizes >= 2 * min_leaf
            sizes, nodes, last = sizes[on], nodes[on], int(on.sum())
            place = np.append(np.where(on, np.cumsum(on) - 1, last), last)  # the last one: rows that are done
            to, end = place[goes].astype(np.uint16 if last < 65536 else np.int64), int(sizes.sum())
            for f, own in enumerate(order):
                order[f] = own[np.argsort(to[own], kind="stable")[:end]]
        return feature[:count], threshold[:count], left[:count], value[:count]

    return tree_of


def walker():
    """``walk``: add a tree's value of the rows of ``x`` (a line per feature) to ``total``."""
    step = _WALKED

    def walk(x, tree, total) -> None:
        import numpy as np

        feature, threshold, left, value = tree
        single = threshold.astype(np.float32)  # features are single: the next single below a threshold parts them alike
        single = np.where(single > threshold, np.nextafter(single, np.float32(-np.inf)), single)
        feature, left, width = feature.astype(np.int64), left.astype(np.int64), len(x)
        for lo in range(0, x.shape[1], step):
            flat = np.ascontiguousarray(x[:, lo : lo + step].T).ravel()
            n = len(flat) // width
            at, on, node = np.zeros(n, dtype=np.int64), np.arange(n), np.zeros(n, dtype=np.int64)
            start = on * width
            while len(on):
                for _ in range(4):  # a leaf leads to itself
                    node = left[node] + (flat[start + feature[node]] > single[node])
                going = np.flatnonzero(left[node] != node)
                at[on] = node
                on, node, start = on[going], node[going], start[going]
            total[lo : lo + n] += value[at]

    return walk


def sorter(piece: int):
    """``orders``: the drawn rows by each feature, for columns of any length."""

    def key_of(x):
        import numpy as np

        bits = x.view(np.uint32)
        return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))

    def grouped(counts):
        """First and last index of runs with at most ``piece`` rows, or of one index with more."""
        import numpy as np

        runs, size = [], 0
        for i in np.flatnonzero(counts).tolist():
            if runs and size + counts[i] <= piece:
                runs[-1][1], size = i, size + counts[i]
            else:
                runs.append([i, i])
                size = counts[i]
        return runs

    def same(a, b, x, f, g):
        """Whether two features order the rows alike, ties included."""
        import numpy as np

        for lo in range(0, len(a), piece):
            one, two = a[lo : lo + piece + 1], b[lo : lo + piece + 1]
            if not np.array_equal(one, two) or not np.array_equal(np.diff(x[f][one]) > 0, np.diff(x[g][one]) > 0):
                return False
        return True

    def orders(x, drawn, make):
        """(feature, rows by it) of the features that can be chosen: not constant, not ordered as one before them is.

        ``drawn`` is a column of flags, ``make`` gives an array of a type and length. Values come in ascending ranges with
        few enough rows to be sorted in memory; equal values keep the rows' order.
        """
        import numpy as np

        n, count = len(drawn), 0
        for lo in range(0, n, piece):
            count += int(np.count_nonzero(drawn[lo : lo + piece]))
        out = []

        def keys(f):
            for lo in range(0, n, piece):
                own = lo + np.flatnonzero(drawn[lo : lo + piece])
                yield key_of(x[f][own]), own

        for f in range(len(x)):
            order, end = make(np.int32 if n < 2**31 else np.int64, count), 0
            counts = sum(np.bincount(k >> 16, minlength=65536) for k, _ in keys(f))
            for first, last in grouped(counts):
                spans = [(first << 16, last << 16 | 65535)]
                if counts[first : last + 1].sum() > piece:
                    inner = sum(np.bincount(k[k >> 16 == first] & 65535, minlength=65536) for k, _ in keys(f))
                    spans = [(first << 16 | a, first << 16 | b) for a, b in grouped(inner)]
                for low, high in spans:
                    parts = []
                    for k, own in keys(f):
                        here = np.flatnonzero((k >= low) & (k <= high))
                        if low == high:  # one value, any number of rows
                            order[end : end + len(here)] = own[here]
                            end += len(here)
                        else:
                            parts.append((k[here], own[here]))
                    if parts:
                        k, own = (np.concatenate(p) for p in zip(*parts))
                        order[end : end + len(k)] = own[np.argsort(k, kind="stable")]
                        end += len(k)
            if x[f][order[0]] < x[f][order[-1]] and not any(same(o, order, x, g, f) for g, o in out):
                out.append((f, order))
        return out

    return orders


def cutter(min_leaf: int, piece: int):
    """``best_cut``: feature, threshold and rows to its left of the best cut of a node of any size, or None where there is none."""

    def best_cut(x, y, w, orders, centre, tiny):
        """``x``, ``y`` and ``w`` are columns of all rows; ``orders`` has the node's rows with draws by each feature."""
        import numpy as np

        n = len(orders[0][1])

        def sums(order):
            up_w = up_s = 0.0
            for lo in range(0, n, piece):
                own = order[lo : lo + piece]
                draws = w[own].astype(float)
                cw, cs = np.cumsum(draws) + up_w, np.cumsum(draws * (y[own] - centre)) + up_s
                up_w, up_s = cw[-1], cs[-1]
                yield lo, cw, cs

        def gains(f, order):
            for lo, cw, cs in sums(order):
                xs = x[f][order[lo : lo + piece + 1]]
                at = np.flatnonzero(xs[:-1] < xs[1:])
                at = at[(at + lo + 1 >= min_leaf) & (n - at - lo - 1 >= min_leaf)]
                if len(at):
                    lw, ls = cw[at], cs[at]
                    yield xs, lo, at, ls**2 / lw + (whole_s - ls) ** 2 / (whole_w - lw) - whole_s**2 / whole_w

        for _, cw, cs in sums(orders[0][1]):
            whole_w, whole_s = cw[-1], cs[-1]
        best = [max((float(g.max()) for *_, g in gains(f, order)), default=-np.inf) for f, order in orders]
        if not max(best) > tiny:
            return None
        enough = max(best) * (1 - 1e-9)
        chosen = next(i for i, g in enumerate(best) if g >= enough)
        for xs, lo, at, g in gains(*orders[chosen]):
            if g.max() >= enough:
                i = at[np.argmax(g >= enough)]
                low, high = float(xs[i]), float(xs[i + 1])
                return chosen, low + (high - low) / 2, int(lo + i + 1)

    return best_cut


def teller(min_leaf: int, max_depth: int | None, held: int, piece: int):
    """``tell``: grow trees on the rows they draw and add their values of every row, drawn or not, to ``total``."""
    tree_of, walk, best_cut, orders_of = tree_maker(min_leaf, max_depth), walker(), cutter(min_leaf, piece), sorter(piece)

    def steps(lo, hi):
        return [(a, min(a + piece, hi)) for a in range(lo, hi, piece)]

    def split(part, goes, spare):
        """Rows for which ``goes`` is true first, in their order on both sides; the number of these."""
        middle = after = 0
        for a, b in steps(0, len(part)):
            own = part[a:b].copy()
            left = goes(own)
            lefts, rights = own[left], own[~left]
            part[middle : middle + len(lefts)] = lefts
            spare[after : after + len(rights)] = rights
            middle, after = middle + len(lefts), after + len(rights)
        for a, b in steps(0, after):
            part[middle + a : middle + b] = spare[a:b]
        return middle

    def tell(x, y, draws, total, make) -> int:
        """``x`` is a list of columns, ``draws`` a column per tree, ``make`` gives an array of a type and length. The number of trees with rows."""
        import numpy as np

        n, grown, sorted_once = len(y), 0, None
        number = np.int32 if n < 2**31 else np.int64
        rows, spare = make(number, n), make(number, n)
        for w in draws:
            drawn = sum(float(w[a:b].sum()) for a, b in steps(0, n))
            if not drawn:
                continue
            grown += 1
            centre = sum(float(w[a:b] @ y[a:b]) for a, b in steps(0, n)) / drawn
            tiny = 1e-12 * sum(float(w[a:b] @ (y[a:b] - centre) ** 2) for a, b in steps(0, n))
            size = sum(int(np.count_nonzero(w[a:b])) for a, b in steps(0, n))
            for a, b in steps(0, n):
                rows[a:b] = np.arange(a, b)
            orders = []
            if size > held:  # the rows of this tree by each feature
                if sorted_once is None:
                    once = make(np.bool_, n)
                    for a, b in steps(0, n):
                        once[a:b] = np.any([d[a:b] > 0 for d in draws], axis=0)
                    sorted_once, side = [(f, o, make(number, len(o))) for f, o in orders_of(x, once, make)], make(np.bool_, n)
                for f, order, own in sorted_once:
                    end = 0
                    for a, b in steps(0, len(order)):
                        some = order[a:b][w[order[a:b]] > 0]
                        own[end : end + len(some)] = some
                        end += len(some)
                    orders.append((f, own[:size]))
            nodes = [(0, size, 0, n, 0)]
            while nodes:
                first, last, lo, hi, depth = nodes.pop()
                levels = None if max_depth is None else max_depth - depth
                if last - first <= held:
                    bag = np.concatenate([own[w[own] > 0] for own in (rows[a:b] for a, b in steps(lo, hi))])
                    tree = tree_of(np.stack([c[bag] for c in x]), y[bag], w[bag].astype(float), tiny, levels)
                    for a, b in steps(lo, hi):
                        own = rows[a:b]
                        out = np.zeros(b - a)
                        walk(np.stack([c[own] for c in x]), tree, out)
                        total[own] += out
                    continue
                here = [(f, order[first:last]) for f, order in orders]
                found = best_cut(x, y, w, here, centre, tiny) if here and levels != 0 else None
                if found is None:
                    of_bag = [(float(w[own] @ y[own]), float(w[own].sum())) for own in (rows[a:b] for a, b in steps(lo, hi))]
                    for a, b in steps(lo, hi):
                        total[rows[a:b]] += sum(s for s, _ in of_bag) / sum(d for _, d in of_bag)
                    continue
                chosen, threshold, lefts = found
                feature, by = here[chosen]
                for a, b in steps(0, last - first):
                    side[by[a:b]] = np.arange(a, b) < lefts
                for i, (_, order) in enumerate(here):
                    if i != chosen:
                        split(order, lambda own: side[own], spare)
                middle = lo + split(rows[lo:hi], lambda own: x[feature][own] <= threshold, spare)
                nodes += [(first + lefts, last, middle, hi, depth + 1), (first, first + lefts, lo, middle, depth + 1)]
        return grown

    return tell
