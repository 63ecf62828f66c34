"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page's tree."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalens.llm.fitting import weights_of
from catalens.llm.tasks import map_batches

# Elements of HTML by their part in the tree.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math annotation merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())  # text up to the end tag, no markup
FOREIGN = frozenset("svg math".split())  # a trailing slash closes them and what they hold
CLOSED_BY_OWN = {  # an open element of the first kind ends where one of the others begins
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option"}, "head": {"body"},
}
# What the elements and class names of pages with marked-up regions say about them.
CONTENT = frozenset("article main articlebody".split())
BOILERPLATE = frozenset(
    "nav aside footer form menu dialog button header "
    "ad ads advert advertisement adsense sponsored promo banner sidebar widget cookie consent notice popup modal comments comment "
    "disqus reply navbar breadcrumb breadcrumbs pagination share social related recommended newsletter subscribe login search "
    "navigation complementary contentinfo".split()
)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Za-z]+")
_STEP = "step "  # no feature has a name with a space


@dataclass(frozen=True)
class Block:
    """A leaf block: text with single spaces, its ancestors (tag, names) from the root, characters in links."""

    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    linked: int


def _names(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = [w.lower() for m in _NAMES.finditer(attributes) for w in _PART.findall(m[2] or m[3] or m[4] or "")]
    return tuple(dict.fromkeys(found))


def blocks(page: str | None) -> list[Block]:
    """The page's leaf blocks in order. Broken markup is read as far as it goes; no text is cut."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = links = 0

    def close_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, tuple(x for x in stack if x[0] not in INLINE), linked))
            parts.clear()
        linked = 0

    def pop_to(at: int) -> None:
        nonlocal links
        links -= sum(x[0] == "a" for x in stack[at:])
        del stack[at:]

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt != at:
            text = unescape(page[at : lt if lt >= 0 else end])
            parts.append(text)
            if links:
                linked += len(text.strip())
        if lt < 0:
            break
        if page.startswith("<!--", lt):
            stop = page.find("-->", lt + 4)
            at = stop + 3 if stop >= 0 else end
            continue
        if page.startswith(("<!", "<?"), lt):
            stop = page.find(">", lt)
            at = stop + 1 if stop >= 0 else end
            continue
        m = _TAG.match(page, lt)
        if m is None:
            if re.match(r"</?[a-zA-Z]", page[lt : lt + 3]):
                break  # a tag cut off by the end of the page
            parts.append("<")
            at = lt + 1
            continue
        at = m.end()
        slash, tag, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
        tag = tag.lower()
        if tag not in INLINE:
            close_block()
        elif tag == "br":
            parts.append(" ")
        if slash:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
                if tag in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        foreign = tag in FOREIGN or any(x[0] in FOREIGN for x in stack)
        if foreign and attributes.endswith("/"):
            continue
        if tag in RAW and not (foreign and tag == "title"):
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            for i in range(len(stack) - 1, -1, -1):
                open_ = stack[i][0]
                if open_ == "p" or tag in CLOSED_BY_OWN.get(open_, ()):
                    pop_to(i)
                    break
                if open_ not in INLINE:
                    break
        if tag == "a":
            links += 1
        if not attributes.endswith("/") or tag in INLINE or tag == "p":
            stack.append((tag, _names(attributes)))
    close_block()
    return out


def path_features(path) -> list[str]:
    """Ancestor-tag features: every tag and name on the way, and the last two tags."""
    tags = [t for t, _ in path]
    found = {f"t:{t}" for t in tags if t not in ("html", "body")} | {f"n:{n}" for _, names in path for n in names}
    found.add("p:" + ">".join(tags[-2:]))
    return sorted(found)


def text_features(block: Block, at: int, of: int) -> list[str]:
    text = block.text
    n = len(text)
    found = [f"len:{min(9, n.bit_length())}", f"link:{min(4, 4 * block.linked // max(n, 1))}", f"end:{text[-1] if text[-1] in '.!?:;,' else '-'}"]
    found.append(f"stops:{min(3, text.count('. ') + text.count(', '))}")
    if "©" in text or "(c)" in text:
        found.append("copyright")
    if at == 0:
        found.append("first")
    if at == of - 1:
        found.append("last")
    return found


@dataclass(frozen=True)
class Crf:
    """Weights of content over boilerplate per feature, and of the changes between blocks; logarithmic."""

    weights: dict[str, float]
    step: tuple[tuple[float, float], tuple[float, float]]

    def decoder(self):
        weights, step, paths = self.weights, self.step, {}
        (s00, s01), (s10, s11) = step

        def labels(page: list[Block]) -> list[int]:
            """Viterbi; a tie goes to content."""
            back, a, b = [], 0.0, 0.0
            for i, block in enumerate(page):
                w = paths.get(block.path)
                if w is None:
                    if len(paths) > 50_000:
                        paths.clear()
                    w = paths[block.path] = sum(weights.get(f, 0.0) for f in path_features(block.path))
                for f in text_features(block, i, len(page)):
                    w += weights.get(f, 0.0)
                if i:
                    to0, to1 = (0 if a + s00 > b + s10 else 1), (0 if a + s01 > b + s11 else 1)
                    back.append((to0, to1))
                    a, b = (a + s00 if to0 == 0 else b + s10), (a + s01 if to1 == 0 else b + s11) + w
                else:
                    b += w
            at = int(b >= a)
            out = [at] * len(page)
            for i in range(len(page) - 2, -1, -1):
                at = out[i] = back[i][at]
            return out

        return labels


def train(pages: list[tuple[list[list[str]], list[int]]], steps: int = 150, rate: float = 0.1, decay: float = 1e-3) -> Crf:
    """Maximum likelihood of (features of each block, labels) pages, by Adam on forward-backward gradients."""
    pages = [(x, y) for x, y in pages if y]
    if not pages:
        return Crf({}, ((0.0, 0.0), (0.0, 0.0)))
    names = sorted({f for x, _ in pages for b in x for f in b})
    column = {f: i for i, f in enumerate(names)}
    longest = max(len(y) for _, y in pages)
    n, k = len(pages), len(names)
    cell = np.array([p * longest + t for p, (x, _) in enumerate(pages) for t, b in enumerate(x) for _ in b])
    col = np.array([column[f] for x, _ in pages for b in x for f in b])
    size = np.array([len(y) for _, y in pages])
    used = np.arange(longest)[None, :] < size[:, None]
    gold = np.zeros((n, longest), dtype=int)
    for p, (_, y) in enumerate(pages):
        gold[p, : len(y)] = y
    pairs = used[:, 1:]
    seen = np.array([[(pairs & (gold[:, :-1] == i) & (gold[:, 1:] == j)).sum() for j in (0, 1)] for i in (0, 1)], dtype=float)
    w, s = np.zeros(k), np.zeros((2, 2))
    m, v = np.zeros(k + 4), np.zeros(k + 4)
    for it in range(1, steps + 1):
        e = np.zeros((n, longest, 2))
        e[:, :, 1] = np.bincount(cell, w[col], n * longest).reshape(n, longest)
        fwd, bwd = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        fwd[:, 0] = e[:, 0]
        for t in range(1, longest):
            step = np.logaddexp(fwd[:, t - 1, :1] + s[0], fwd[:, t - 1, 1:] + s[1]) + e[:, t]
            fwd[:, t] = np.where(used[:, t, None], step, fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            nxt = e[:, t + 1] + bwd[:, t + 1]
            step = np.logaddexp(nxt[:, :1] + s[:, 0], nxt[:, 1:] + s[:, 1])
            bwd[:, t] = np.where(used[:, t + 1, None], step, 0.0)
        whole = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        share = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - whole[:, None]) * used
        g_w = np.bincount(col, (share - gold * used).ravel()[cell], k) / n + decay * w
        g_s = np.zeros((2, 2))
        for i in (0, 1):
            for j in (0, 1):
                both = fwd[:, :-1, i] + s[i, j] + e[:, 1:, j] + bwd[:, 1:, j] - whole[:, None]
                g_s[i, j] = (np.exp(np.where(pairs, both, -np.inf)).sum() - seen[i, j]) / n + decay * s[i, j]
        g = np.append(g_w, g_s.ravel())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.999**it)) + 1e-8)
        w -= move[:k]
        s -= move[k:].reshape(2, 2)
    return Crf({f: float(w[i]) for f, i in column.items()}, tuple(map(tuple, s.tolist())))


def marked_labels(page: list[Block]) -> list[int] | None:
    """Labels of a page that marks its article up: content lies in it and in no region of another kind; else None."""
    out, any_ = [], False
    for b in page:
        inside = other = False
        for tag, names in b.path:
            words = {tag, *names}
            if words & CONTENT:
                inside, other = True, False
            elif words & BOILERPLATE and (tag not in ("html", "body")):
                other = True
        any_ |= inside
        out.append(int(inside and not other))
    return out if any_ else None


def variants(page: list[Block], labels: list[int], seed: int, others: int = 3):
    """The page itself, and some that lost or renamed its marks and gained regions of other kinds from its own text.

    Real pages mark their regions in many ways; a variant has names from the fixed lists in place of the
    page's own, so that the field learns these, the text features and the order of blocks as well.
    """
    yield page, labels
    rng = np.random.default_rng(seed)
    for _ in range(others):
        yield _variant(page, labels, rng)


def _variant(page: list[Block], labels: list[int], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    kinds = sorted(BOILERPLATE)
    content = [("div", ("content",)), ("div", ("post",)), ("section", ("entry",)), ("main", ()), ("div", ("article",)), ("div", ("story", "body")), ("article", ())]
    own = content[rng.integers(len(content))]
    html = ("html", ()), ("body", ())
    made, marks, region = [], [], None
    for b, y in zip(page, labels):
        if y:
            made.append(Block(b.text, (*html, own, b.path[-1]), b.linked))
        else:
            region = region if region and rng.random() < 0.7 else kinds[rng.integers(len(kinds))]
            tag = (region, ()) if region in ("nav", "aside", "footer", "form", "header") else ("div", (region,))
            made.append(Block(b.text, (*html, tag, b.path[-1]), b.linked))
        marks.append(y)
        if rng.random() < 0.25:  # a notice, advert or comment, often within the article
            kind = kinds[rng.integers(len(kinds))]
            tag = (kind, ()) if kind in ("nav", "aside", "footer", "form", "header") else ("div", (kind,))
            words = page[rng.integers(len(page))].text.split()[: int(rng.integers(2, 30))]
            around = (*html, own, tag) if rng.random() < 0.6 else (*html, tag)
            made.append(Block(" ".join(words), (*around, ("p", ())), 0))
            marks.append(0)
    return made, marks


def fit(pages: DataFrame, html: str = "html", row_id: str = "page_id", max_pages: int = 800, max_blocks: int = 120) -> Crf:
    """Train on pages whose markup labels their regions, a sample bounded by ``max_pages`` in expectation.

    The sample are the rows whose hash lies below the share of ``max_pages`` in the table; pages of more
    than ``max_blocks`` blocks teach nothing more and are left out of it.
    """
    total = pages.count()
    unit = F.pmod(F.xxhash64(row_id), F.lit(1 << 30)) / (1 << 30)
    sample = pages.filter(unit < max_pages / max(total, 1)).select(F.col(html).cast("string"))

    def learn(table: pa.Table) -> dict[str, float]:
        learned = []
        # in the order of the pages, so that the fit doesn't depend on the order of the rows
        for i, page in enumerate(sorted(p for p in table.column(0).to_pylist() if p)):
            found = blocks(page)
            labels = marked_labels(found)
            if labels and len(found) <= max_blocks:
                for b, y in variants(found, labels, i):
                    learned.append(([path_features(x.path) + text_features(x, j, len(b)) for j, x in enumerate(b)], y))
        model = train(learned)
        return {**model.weights, **{f"{_STEP}{i}{j}": model.step[i][j] for i in (0, 1) for j in (0, 1)}}

    found = weights_of(sample, learn)
    if not found:
        return train([])
    step = tuple(tuple(found.pop(f"{_STEP}{i}{j}") for j in (0, 1)) for i in (0, 1))
    return Crf(found, step)


def extract(pages: DataFrame, model: Crf, row_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(row_id, url, text, n_chars): content blocks in page order, joined by an empty line.

    Null and empty pages, and pages without a content block, have an empty text. One row per row of
    ``pages``, repeated rows and null ids included; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)  # bounded by the fit sample
    kinds = dict(pages.dtypes)

    def run(batches):
        labels = shared.value.decoder()
        for b in batches:
            texts = []
            for h in b.column(2):
                found = blocks(h.as_py())
                texts.append("\n\n".join(x.text for x, y in zip(found, labels(found)) if y))
            made = pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *made], names=[row_id, url, "text", "n_chars"])

    chosen = pages.select(row_id, url, F.col(html).cast("string"))
    return map_batches(chosen, run, f"`{row_id}` {kinds[row_id]}, `{url}` {kinds[url]}, text string, n_chars long")
