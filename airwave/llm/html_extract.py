"""Main-text extraction with a tree-structured graphical model.

Tree.  A page is parsed into its DOM: block elements, and text blocks as
leaves.  Inline markup joins the block around it; scripts, styles, comments
and declarations carry no text; unclosed and stray tags follow the usual rules
(a block start closes an open paragraph, an end tag closes up to its start).

Model.  Every node is content or not.  Its own evidence is a sum of log-odds
of features (semantic tag, words of class, id and role, length, share of
linked text, closing punctuation); a text block's own evidence for content is
kept small, as advertisements and comments are prose too.  A parent-child potential, by the child's
kind, is the probability of the child's state given the parent's.
Sum-product message passing, upward from the leaves and downward from the
root, gives every block's marginal; blocks above one half are the text.

Training.  Labelled pages are (html, text) pairs.  The run of blocks that
spells the text is content, and so is a heading before it that repeats its
beginning; an element is content if most of its text is.  Potentials and
log-odds are smoothed relative frequencies, summed by Spark over a bounded
sample (``TRAIN_PAGES`` pages).  ``PRIOR`` holds pseudo-counts for usual names
of page parts, so parts that no labelled page shows are known too; without any
labelled page the prior alone decides.  Elements that stand in any part of a
page (div, section, lists, tables, paragraphs, headings) have no tag evidence.

Defined results: null or empty html gives an empty text; equal rows give equal
results; an empty table gives an empty result; extra columns travel in ``row``.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import extended

TRAIN_PAGES = 2000
SMOOTH = 1.0
EVIDENCE = 6.0
LEAF_EVIDENCE = {"linked": (-3.0, 0.0), "plain": (-0.5, 0.25)}
STAY = 19.0

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var label".split())
RAW = frozenset("script style template noscript iframe svg textarea title select".split())
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table html body article section div td th".split())

SEMANTIC = frozenset("article main nav header footer aside form h1 h2 h3 h4 h5 h6 p blockquote pre figure figcaption "
                     "address head menu dialog button fieldset".split())
TELLING = SEMANTIC - frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre figure figcaption".split())

# Pseudo-counts (not content, content) for tags and words of class, id and role.
PRIOR_AGAINST = ("nav header footer aside form menu dialog button fieldset head address").split()
PRIOR_FOR = ("article main").split()
WORDS_AGAINST = ("ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie "
                 "cookies consent gdpr notice alert popup modal overlay menu nav navbar navigation breadcrumb "
                 "breadcrumbs sidebar aside widget footer header masthead comment comments reply replies disqus "
                 "respondent share sharing social related recommended newsletter subscribe signup login search "
                 "pagination pager copyright legal toolbar complementary contentinfo").split()
WORDS_FOR = "article content post entry story body main text".split()
PRIOR_COUNT = 40.0

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")


class Page:
    """Parallel lists of nodes in document order: parent number, kind, features, text (leaves only)."""

    def __init__(self, source: str):
        self.parent, self.kind, self.features, self.text = [-1], ["root"], [()], [None]
        self.open = [(0, "root")]
        self.parts: list[str] = []
        self.linked = self.size = 0
        self.links = 0
        self.read(source)
        self.flush()

    def add(self, kind: str, features: tuple, text: str | None) -> int:
        self.parent.append(self.open[-1][0])
        self.kind.append(kind)
        self.features.append(features)
        self.text.append(text)
        return len(self.kind) - 1

    def flush(self) -> None:
        """End the current text block."""
        if self.parts:
            text = " ".join(entities.unescape("".join(self.parts)).split())
            if text:
                n = text.count(" ") + 1
                share = self.linked / max(1, self.size)
                self.add("text", (f"n{min(n.bit_length(), 6)}", "l0" if share == 0 else "l1" if share < 0.5 else "l2",
                                  "stop" if text[-1] in ".!?\"'…»”" else "open"), text)
        self.parts, self.linked, self.size = [], 0, 0

    def close(self, name: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][1] == name:
                self.flush()
                del self.open[k:]
                return

    def start(self, name: str, attributes: str) -> None:
        self.flush()
        if any(n == "p" for _, n in self.open):
            self.close("p")
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][1] in IMPLIED.get(name, ()):
                del self.open[k:]
                break
            if self.open[k][1] in SCOPES:
                break
        features = [f"t:{name}"] if name in TELLING else []
        if attributes.strip():
            words = {w for m in NAMES.finditer(attributes) for w in WORD.findall((m[1] or m[2] or m[3] or "").lower())}
            features += [f"w:{w}" for w in sorted(words)]
        self.open.append((self.add(name if name in SEMANTIC else "box", tuple(features), None), name))

    def read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            m = TOKEN.search(source, at)
            self.gather(source[at:m.start()] if m else source[at:])
            if not m:
                return
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if name in RAW and not m[1]:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else n
            elif name == "br" or name == "hr":
                self.flush()
            elif name in INLINE:
                if name == "a":
                    self.links = max(0, self.links + (-1 if m[1] else 1))
            elif name in VOID:
                continue
            elif m[1]:
                self.links = 0
                self.close(name)
            else:
                self.links = 0
                self.start(name, m[3])

    def gather(self, text: str) -> None:
        if text:
            self.parts.append(text)
            n = len(text.strip())
            self.size += n
            self.linked += n if self.links else 0

    def leaves(self) -> list[int]:
        return [i for i, t in enumerate(self.text) if t is not None]


def labels_of(page: Page, truth: str) -> list[int] | None:
    """1 or 0 for every node, or None if no run of blocks spells the text."""
    wanted = " ".join(truth.split())
    leaves = page.leaves()
    for s in range(len(leaves)):
        at, e = 0, s
        while e < len(leaves) and at < len(wanted) and wanted.startswith(page.text[leaves[e]], at):
            at += len(page.text[leaves[e]]) + 1
            e += 1
        if e > s and at >= len(wanted):
            break
    else:
        return None
    chosen = set(leaves[s:e])
    if s and page.kind[page.parent[leaves[s - 1]]] in ("h1", "h2") and wanted.startswith(page.text[leaves[s - 1]]):
        chosen.add(leaves[s - 1])
    inside, total = [0] * len(page.kind), [0] * len(page.kind)
    for i in range(len(page.kind) - 1, -1, -1):
        if page.text[i] is not None:
            total[i] = len(page.text[i])
            inside[i] = total[i] if i in chosen else 0
        if page.parent[i] >= 0:
            total[page.parent[i]] += total[i]
            inside[page.parent[i]] += inside[i]
    return [int(2 * a > b) for a, b in zip(inside, total)]


def counts_of(page: Page, labels: list[int]) -> Counter:
    """Counts of (what, state): features by state, nodes by state, children by kind, parent's state and state."""
    out: Counter = Counter()
    for i, x in enumerate(labels):
        scope = "leaf" if page.text[i] is not None else "box"
        out[f"n:{scope}", x] += 1
        for f in page.features[i]:
            out[f, x] += 1
        if i:
            out[f"p:{page.kind[i]}:{labels[page.parent[i]]}", x] += 1
        else:
            out["root", x] += 1
    return out


class Model:
    """Log-odds of features, and transition probabilities by kind of child."""

    def __init__(self, counts: dict):
        total = Counter(counts)
        for names, add in ((["t:" + t for t in PRIOR_AGAINST] + ["w:" + w for w in WORDS_AGAINST], (PRIOR_COUNT, 0)),
                           (["t:" + t for t in PRIOR_FOR] + ["w:" + w for w in WORDS_FOR], (0, PRIOR_COUNT / 4))):
            for name in names:
                for x in (0, 1):
                    total[name, x] += add[x]
        for scope in ("leaf", "box"):
            for x in (0, 1):
                total[f"n:{scope}", x] += 4 * PRIOR_COUNT
        for f, x in (("l2", 0), ("l0", 1)):
            total[f, x] += PRIOR_COUNT / 4
        self.odds = {}
        for f in {f for f, _ in total}:
            if f.startswith(("n:", "p:", "root")):
                continue
            scope = "box" if f[1] == ":" else "leaf"
            share = [(total[f, x] + SMOOTH) / (total[f"n:{scope}", x] + 2 * SMOOTH) for x in (0, 1)]
            self.odds[f] = max(-EVIDENCE, min(EVIDENCE, math.log(share[1] / share[0])))
        self.moves = {}
        for kind in {"box", "text", *SEMANTIC}:
            rows = []
            for x in (0, 1):
                # Plain containers just follow their parent; other kinds are smoothed towards that.
                seen = [0 if kind == "box" else total[f"p:{kind}:{x}", y] for y in (0, 1)]
                pseudo = [STAY if y == x else 1.0 for y in (0, 1)]
                both = [s + p for s, p in zip(seen, pseudo)]
                rows.append([max(0.01, b / sum(both)) for b in both])
            self.moves[kind] = rows
        root = [total["root", x] + 1 for x in (0, 1)]
        self.root = [r / sum(root) for r in root]

    def marginals(self, page: Page) -> list[float]:
        """Probability of content of every node, by one upward and one downward pass."""
        n = len(page.kind)
        odds, parent, kind = self.odds, page.parent, page.kind
        moves = [self.moves[k] if k != "root" else None for k in kind]
        own0, own1 = [1.0] * n, [1.0] * n
        for i in range(n):
            w = 0.0
            for f in page.features[i]:
                w += odds.get(f, 0.0)
            if page.text[i] is not None:
                low, high = LEAF_EVIDENCE["linked" if "l2" in page.features[i] else "plain"]
                w = max(low, min(high, w))
            if w > 0:
                own0[i] = math.exp(-min(w, 30.0))
            else:
                own1[i] = math.exp(max(w, -30.0))
        up0, up1 = [1.0] * n, [1.0] * n
        for i in range(n - 1, 0, -1):
            (a, b), (c, d) = moves[i]
            x0, x1 = own0[i], own1[i]
            u0, u1 = a * x0 + b * x1, c * x0 + d * x1
            s = u0 + u1
            up0[i], up1[i] = u0 / s, u1 / s
            p = parent[i]
            y0, y1 = own0[p] * up0[i], own1[p] * up1[i]
            s = y0 + y1
            own0[p], own1[p] = y0 / s, y1 / s
        # own now holds each node's evidence with its children's messages; belief adds the message from above.
        b0, b1 = own0[0] * self.root[0], own1[0] * self.root[1]
        belief0, belief1 = [0.0] * n, [0.0] * n
        belief0[0], belief1[0] = b0 / (b0 + b1), b1 / (b0 + b1)
        for i in range(1, n):
            p = parent[i]
            (a, b), (c, d) = moves[i]
            q0, q1 = belief0[p] / up0[i], belief1[p] / up1[i]
            b0, b1 = (q0 * a + q1 * c) * own0[i], (q0 * b + q1 * d) * own1[i]
            s = b0 + b1
            belief0[i], belief1[i] = b0 / s, b1 / s
        return belief1

    def extract(self, source: str | None) -> str:
        if not source:
            return ""
        page = Page(source)
        belief = self.marginals(page)
        return " ".join(t for t, b in zip(page.text, belief) if t is not None and b > 0.5)


def train(labelled: DataFrame) -> Model:
    """Fit on a bounded sample of labelled pages (html, text); rows whose text the page does not spell are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for source, truth in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                page = Page(source)
                labels = labels_of(page, truth)
                if labels:
                    total += counts_of(page, labels)
        rows = sorted(total.items())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()),
                                          pa.array([k[1] for k, _ in rows], pa.int32()),
                                          pa.array([v for _, v in rows], pa.int64())], names=["what", "state", "n"])

    pairs = labelled.select("html", "text").where("length(html) > 0 AND length(trim(text)) > 0")
    counts = pairs.mapInArrow(run, "what string, state int, n long").groupBy("what", "state").agg(F.sum("n").alias("n"))
    return Model({(r["what"], r["state"]): r["n"] for r in counts.collect()})


def extract(pages: DataFrame, model: Model, html_col: str = "html") -> DataFrame:
    """(row struct of the input's columns without the html, text string, n_chars long) of every page."""
    keep = [pages[f"`{c}`"] for c in pages.columns if c != html_col]
    rows = pages.select(F.struct(*keep).alias("row"), pages[f"`{html_col}`"].alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [model.extract(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()),
                                              pa.array(list(map(len, texts)), pa.int64())],
                                             names=["row", "text", "n_chars"])

    return rows.mapInArrow(run, extended(rows.select("row"), "text string, n_chars long"))


def labelled_sample(pages: DataFrame, texts: DataFrame, limit: int = TRAIN_PAGES) -> DataFrame:
    """At most ``limit`` (html, text) pairs: pages whose address ends in the number of a known text.

    The sample's ids (``limit`` of them at most) are chosen by hash and
    broadcast; only their rows of either table go on.
    """
    number = F.regexp_extract("url", r"/(\d+)(?:[./?#][^/]*)?/?$", 1)
    ids = (pages.select("page_id", number.try_cast("long").alias("doc_id")).where("page_id IS NOT NULL AND doc_id IS NOT NULL")
           .orderBy(F.xxhash64("page_id"), "page_id").limit(limit))
    chosen = texts.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("page_id", "text")
    return pages.select("page_id", "html").join(chosen, "page_id")
