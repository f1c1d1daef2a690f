"""Operator 3, HTML extraction: a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, in page order,
each with its ancestors.  A two-label chain (main text, rest) scores a block by features
of its ancestors' tags, classes and ids and of its text, and neighbours by transitions.
Viterbi decoding picks the best labelling of the whole page; the main blocks are the text.

Training pages are labelled by their own markup: a page with one ``article`` or ``main``
element is main text inside it, less any navigation, aside, form, footer and the like.
Each is also laid out anew in ``LAYOUTS`` ways, with the semantic tags replaced by plain
ones under usual class names, and with notices, forms, sidebars and reader comments
around and inside the article, so that the model knows pages without semantic tags.
At most ``SAMPLE_PAGES`` pages, those with the smallest hashes, are used; the weights
(``SLOTS`` hashed features) are fitted by gradient steps on the chain's likelihood.

Defined cases: null, empty and text-free pages give the empty text; markup inside
scripts, styles, comments and the head is no text; formulas are text, their annotations
are not; unclosed and stray tags are allowed: a head ends where the body or anything that
it cannot hold starts, svg and math end at their end tag, slash or the next html block;
white space (any Unicode white space, and line breaks) becomes one space; if no page is
labelled, the chain is trained on ``BUILT_IN`` pages, laid out anew likewise; repeated rows each get their text; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewash.llm.common import frees, hash_share

#: Pages that the model is trained on, and bytes of html that a training page may have.
SAMPLE_PAGES, SAMPLE_BYTES = 150, 100_000
SLOTS = 1 << 14
EPOCHS, RATE, DECAY = 6, 0.2, 1e-4
MAIN, REST = 1, 0

BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section
summary table tbody td tfoot th thead tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("""head script style noscript template svg annotation annotation-xml iframe object canvas audio video select
option datalist button textarea title""".split())
#: What a head may hold; anything else ends it.
HEAD = set("html head base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements of other languages, whose parts may close themselves, and the html tags that end them,
#: but for inside the ``POINTS``.
FOREIGN = {"svg", "math"}
BREAKOUT = set("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing
menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var""".split())
POINTS = set("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
#: An open element of the key is closed when one of the values starts.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
             "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
             "option": {"option"}, "p": BLOCKS}
#: Semantic tags whose text is not main text, wherever they stand.
ASIDE = set("nav aside footer form header menu dialog fieldset search".split())


class Path:
    """An element's ancestors and itself, as (tag, names) pairs from the root; paths share
    their ancestors, so a deep page takes no more memory than a flat one."""

    __slots__ = ("parent", "item", "depth", "seen", "near")

    def __init__(self, parent: Path | None, item: tuple[str, tuple[str, ...]]) -> None:
        self.parent, self.item, self.depth = parent, item, parent.depth + 1 if parent else 1
        self.seen: frozenset[str] | None = None
        self.near: str | None = None

    @classmethod
    def of(cls, items) -> Path | None:
        path = None
        for item in items:
            path = cls(path, item)
        return path

    def __len__(self) -> int:
        return self.depth

    def __reversed__(self) -> Iterator[tuple]:
        at = self
        while at:
            yield at.item
            at = at.parent

    def __iter__(self) -> Iterator[tuple]:
        return reversed(list(reversed(self)))

    def __getitem__(self, i: int) -> tuple:
        return self.item if i == -1 else list(self)[i]

    def features(self) -> tuple[frozenset[str], str | None]:
        """Features of all elements of the path, and that of the nearest one that says something.
        An element that adds nothing shares its parent's set."""
        todo, at = [], self
        while at and at.seen is None:
            todo.append(at)
            at = at.parent
        seen, near = (at.seen, at.near) if at else (frozenset(), None)
        for at in reversed(todo):
            tag, names = at.item
            own = {f"in={tag}", *(f"name={x}" for x in names), *(f"start={x[:5]}" for x in names if len(x) > 4)}  # commentlist as comment
            seen = seen if own <= seen else seen | own
            if names or tag not in ("p", "div", "li", "td", "tr", "tbody", "body", "html", "section"):
                near = f"near={names[0] if names else tag}"
            at.seen, at.near = seen, near
        return seen, near


class Blocks(HTMLParser):
    """Collects leaf blocks: (text, characters in links, ancestors as (tag, names))."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, Path | None]] = []
        self.open: Counter[str] = Counter()
        self.found: list[tuple[str, int, tuple]] = []
        self.text: list[str] = []
        self.linked = 0
        self.hidden = 0
        self.links = 0
        self.heads = 0
        self.foreign = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.found.append((text, min(self.linked, len(text)), self._path() or ()))
        self.text, self.linked = [], 0

    def _path(self) -> Path | None:
        return self.stack[-1][1] if self.stack else None

    def _pop(self) -> None:
        tag, _ = self.stack.pop()
        self.open[tag] -= 1
        self.hidden -= tag in HIDDEN
        self.links -= tag == "a"
        self.heads -= tag == "head"
        self.foreign -= tag in FOREIGN

    def _enter(self, tag: str) -> None:
        """Close what the start of a tag ends without an end tag: the head, and svg or math."""
        if self.heads and tag not in HEAD:
            at = next(i for i, (x, _) in enumerate(self.stack) if x == "head")
            if tag == "body" or at == len(self.stack) - 1:
                while len(self.stack) > at:
                    self._pop()
        if self.foreign and tag in BREAKOUT:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in POINTS:
                    break
                if self.stack[i][0] in FOREIGN:
                    while len(self.stack) > i:
                        self._pop()
                    break

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._enter(tag)
        if tag == "head" and any(x != "html" for x, _ in self.stack):
            return
        if tag == "br":
            self.text.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
            for i in range(len(self.stack) - 1, -1, -1):
                open_tag = self.stack[i][0]
                if tag in CLOSED_BY.get(open_tag, ()):
                    while len(self.stack) > i:
                        self._pop()
                    break
                if open_tag in BLOCKS and open_tag not in ("p",):
                    break
        if tag in VOID:
            return
        names: tuple[str, ...] = ()
        if attrs and tag in BLOCKS and tag not in ("html", "body"):
            names = tuple(t for k, v in attrs if k in ("class", "id", "role", "itemprop") and v for t in tokens(v))
        self.stack.append((tag, Path(self._path(), (tag, names)) if tag in BLOCKS else self._path()))
        self.open[tag] += 1
        self.hidden += tag in HIDDEN
        self.links += tag == "a"
        self.heads += tag == "head"
        self.foreign += tag in FOREIGN

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in FOREIGN:
            self._enter(tag)
        elif tag in BREAKOUT or not self.foreign:
            self.handle_starttag(tag, attrs)  # as browsers do: the slash means nothing

    def handle_endtag(self, tag: str) -> None:
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if tag in BLOCKS:
                    self.flush()
                while len(self.stack) > i:
                    self._pop()
                return

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and not data.isspace():
            self._pop()
        if not self.hidden:
            self.text.append(data)
            if self.links:
                self.linked += len(data)


def tokens(value: str) -> list[str]:
    """Lower-case words of a class or id: ``siteNav-main`` has site, nav and main."""
    return [t.lower() for t in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", value)]


def blocks(html: str | None) -> list[tuple[str, int, tuple]]:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.found


def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode()) & (SLOTS - 1)


_SLOT_OF: dict[str, int] = {}


def features(found: list[tuple[str, int, tuple]]) -> list[list[int]]:
    """Feature slots of each block."""
    out = []
    ordered: dict[int, tuple[frozenset[str], list[str]]] = {}  # blocks of one element share a set
    for i, (text, linked, path) in enumerate(found):
        n = text.count(" ") + 1
        mine = ["bias", f"words={min(n.bit_length(), 8)}", f"links={4 * linked // max(1, len(text))}",
                f"ends={text[-1] in '.!?:;'}", f"tag={path[-1][0] if path else ''}", f"sign={'©' in text}",
                f"first={i == 0}", f"last={i == len(found) - 1}", f"depth={min(len(path), 8)}"]
        seen, near = (path if isinstance(path, Path) else Path.of(path)).features() if path else (frozenset(), None)
        if near:
            mine.append(near)
        if id(seen) not in ordered:
            ordered[id(seen)] = (seen, sorted(seen))
        slots = []
        for f in (*mine, *ordered[id(seen)][1]):
            s = _SLOT_OF.get(f)
            if s is None:
                s = _slot(f)
                if len(_SLOT_OF) < 1 << 16:
                    _SLOT_OF[f] = s
            slots.append(s)
        out.append(slots)
    return out


class Chain:
    """A linear chain with two labels: weights (SLOTS x 2), transitions (2 x 2)."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray) -> None:
        self.weights, self.moves = weights, moves

    def scores(self, slots: list[list[int]]) -> np.ndarray:
        sizes = [len(s) for s in slots]
        flat = np.fromiter((x for s in slots for x in s), np.int64, sum(sizes))
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.add.reduceat(self.weights[flat], starts, axis=0)

    def viterbi(self, slots: list[list[int]]) -> list[int]:
        if not slots:
            return []
        s, (a, b), (c, d) = self.scores(slots).tolist(), self.moves[0].tolist(), self.moves[1].tolist()
        x, y = s[0]
        back = []
        for p, q in s[1:]:
            from0, from1 = x + a >= y + c, x + b >= y + d
            back.append((0 if from0 else 1, 0 if from1 else 1))
            x, y = (x + a if from0 else y + c) + p, (x + b if from1 else y + d) + q
        label = int(y > x)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def marginals(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(label) per block, expected transitions) by forward and backward sums."""
        n = len(s)
        fwd, bwd = np.empty((n, 2)), np.zeros((n, 2))
        fwd[0] = s[0]
        for i in range(1, n):
            fwd[i] = s[i] + np.logaddexp(fwd[i - 1, 0] + self.moves[0], fwd[i - 1, 1] + self.moves[1])
        for i in range(n - 2, -1, -1):
            nxt = s[i + 1] + bwd[i + 1]
            bwd[i] = np.logaddexp(self.moves[:, 0] + nxt[0], self.moves[:, 1] + nxt[1])
        z = np.logaddexp(*fwd[-1])
        pair = np.exp(fwd[:-1, :, None] + self.moves[None] + (s[1:] + bwd[1:])[:, None, :] - z)
        return np.exp(fwd + bwd - z), pair.sum(axis=0)


def fit(pages: list[tuple[list[list[int]], list[int]]]) -> Chain:
    """Gradient ascent (per-weight rates) on the likelihood of the labelled pages."""
    model = Chain(np.zeros((SLOTS, 2)), np.zeros((2, 2)))
    grown, grown_moves = np.full((SLOTS, 2), 1e-3), np.full((2, 2), 1e-3)
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in order.permutation(len(pages)):
            slots, labels = pages[k]
            if not slots:
                continue
            p, moves = model.marginals(model.scores(slots))
            y = np.zeros_like(p)
            y[np.arange(len(labels)), labels] = 1
            flat = np.concatenate([np.array(s) for s in slots])
            owner = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
            at, inverse = np.unique(flat, return_inverse=True)
            g = np.zeros((len(at), 2))
            np.add.at(g, inverse, (y - p)[owner])
            g -= DECAY * model.weights[at]
            grown[at] += g * g
            model.weights[at] += RATE * g / np.sqrt(grown[at])
            real = np.zeros((2, 2))
            np.add.at(real, (labels[:-1], labels[1:]), 1)
            gm = real - moves - DECAY * model.moves
            grown_moves += gm * gm
            model.moves += RATE * gm / np.sqrt(grown_moves)
    return model


def labels_by_markup(found: list[tuple[str, int, tuple]]) -> list[int] | None:
    """Labels of a page with main text in one ``article`` or ``main``; None without."""
    out = []
    for _, _, path in found:
        tags = [t for t, _ in path]
        inside = next((i for i, t in enumerate(tags) if t in ("article", "main")), None)
        out.append(MAIN if inside is not None and not ASIDE & set(tags[inside:]) else REST)
    return out if any(out) else None


#: Usual class names of page parts, for the training layouts.
PART_NAMES = {
    "main": """content main-content article article-body post post-content entry entry-content story story-body
        body-text page-content single-post blog-post news-text""".split(),
    "nav": "nav navbar navigation menu main-menu breadcrumb breadcrumbs topnav tabs pagination skip-links".split(),
    "header": "header site-header masthead top-bar branding logo banner page-header".split(),
    "footer": "footer site-footer colophon copyright bottom-bar footer-links legal contentinfo".split(),
    "sidebar": "sidebar widget widget-area related related-posts aside rail recommended popular trending tags complementary note callout".split(),
    "notice": "notice cookie-banner cookie-notice consent gdpr alert disclaimer popup modal overlay paywall".split(),
    "ad": "ad ads advert advertisement sponsored promo sponsor ad-slot adsbox banner-ad".split(),
    "form": "form search-form newsletter subscribe signup login contact-form search".split(),
    "comments": "comments comment comment-list reader-comments discussion replies respond disqus responses commentlist comments-area feedback".split(),
    "share": "share social social-share byline meta author-box toolbar".split(),
}
LAYOUTS = 10


def layouts(found: list[tuple[str, int, tuple]], labels: list[int], seed: int) -> list[tuple[list, list[int]]]:
    """The page laid out anew: same texts, other elements and names around them."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    main = [(t, k, p[-1][0] if p else "p") for (t, k, p), y in zip(found, labels) if y == MAIN]
    rest = [(t, k, p[-1][0] if p else "p") for (t, k, p), y in zip(found, labels) if y == REST] or [("x", 0, "p")]
    spare = rest + main  # texts for parts: any text, so that only structure tells them apart
    semantic = {"nav": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}
    out = []
    for _ in range(LAYOUTS):
        bare = rng.random() < 0.15  # no names anywhere: only the texts and their links tell parts apart
        root = [("html", ()), ("body", ())] + [("div", tuple(tokens(pick(["wrapper", "page", "site", "container", "root"]))))] * int(rng.integers(0, 2))

        def part(kind: str, base: list, sizes=(1, 6)) -> list:
            tag = semantic[kind] if kind in semantic and rng.random() < 0.5 else pick(["div", "section", "div", "ul", "ol"])
            named = () if tag in semantic.values() and rng.random() < 0.7 else tuple(tokens(pick(PART_NAMES[kind])))
            if tag in semantic.values() and rng.random() < 0.3:  # a name that says nothing
                named = ("".join(pick("bcdfghjklmnpqrstvwz") for _ in range(6)),)
            if bare:
                if kind not in ("nav", "header", "footer"):
                    return []
                tag, named = pick(["div", "ul"]), ()
            at = base + [(tag, named)]
            rows = []
            for _ in range(int(rng.integers(*sizes))):
                t, _, _ = pick(spare)
                words = t.split(" ")
                t = " ".join(words[:int(rng.integers(1, 60 if kind in ("comments", "notice", "ad", "sidebar") else 8))])
                leaf = pick(["p", "div", "li", "span", "h3"] if kind not in ("nav",) else ["li", "li", "p"])
                path = at + ([("div", tuple(tokens(pick(PART_NAMES[kind]))))] if rng.random() < 0.3 and not bare else [])
                path = path if leaf == "span" else path + [(leaf, ())]
                rows.append((t, len(t) if kind == "nav" or rng.random() < 0.2 else 0, tuple(path)))
            return rows

        if rng.random() < 0.35:
            body = root + [(pick(["article", "main"]), () if rng.random() < 0.6 else tuple(tokens(pick(PART_NAMES["main"]))))]
        else:
            body = root + [(pick(["div", "div", "section", "td"]), tuple(tokens(pick(PART_NAMES["main"]))))]
        if rng.random() < 0.3:
            body = body + [("div", tuple(tokens(pick(PART_NAMES["main"]))))]
        if bare:
            body = root + [("div", ())]
        page, y = [], []

        def add(rows: list, label: int) -> None:
            page.extend(rows)
            y.extend([label] * len(rows))

        for kind in ("notice", "header", "nav", "ad", "form"):
            if rng.random() < 0.5:
                add(part(kind, root), REST)
        other = None  # other leaves than paragraphs come in runs, as list items do
        for t, k, leaf in main:
            leaf = leaf if leaf in ("h1", "h2", "h3", "p", "li", "blockquote", "pre", "td") else pick(["p", "div"])
            inside = body
            other = other if other and rng.random() < 0.7 else None
            if other or rng.random() < 0.2:
                leaf = other = other or pick(["li", "li", "li", "blockquote", "pre", "h2", "td", "dd", "figcaption"])
                inside = body + {"li": [("ul", ())], "td": [("table", ()), ("tr", ())], "dd": [("dl", ())],
                                 "figcaption": [("figure", ())]}.get(leaf, [])
            add([(t, k, tuple(inside + [(leaf, ())]))], MAIN)
            if rng.random() < 0.15:
                add(part(pick(["ad", "form", "share", "sidebar", "notice"]), body, (1, 3)), REST)
        inner = body if rng.random() < 0.5 else root
        for kind in ("share", "comments", "sidebar"):
            if rng.random() < 0.5:
                add(part(kind, inner), REST)
        for kind in ("sidebar", "ad", "notice", "footer"):
            if rng.random() < 0.5:
                add(part(kind, root), REST)
        out.append((page, y))
    return out


#: Made-up labelled pages for tables that have none.
BUILT_IN = ["""<html><body><header><p>The Daily Example</p></header><nav><ul><li><a href=a>Home</a><li><a href=b>News</a>
<li><a href=c>About us</a></ul></nav><article><h1>A bridge over the river is to be mended this summer</h1><p>The old stone
bridge by the mill will be closed from June, as its second arch has moved by the width of a hand.</p><p>Work is to take
eleven weeks; carts and cars go by the northern road until then. The council met on Tuesday and found that waiting would
cost more.</p><h2>What comes next</h2><p>Masons from three villages will look at the stones in May.</p><ul><li>First the
piers are made dry.<li>Then the arch is taken down.</ul></article><aside><p><a href=d>Most read this week</a></p><p>Ten
soups for cold days</p></aside><footer><p>© The Daily Example</p><p><a href=e>Terms</a></p></footer></body></html>""",
            """<html><body><nav><p><a href=a>Index</a></p><p><a href=b>Recipes</a></p></nav><main><h2>Bread without
kneading</h2><p>Stir flour, water, salt and a little yeast in a bowl, cover it and go to bed.</p><p>In the morning the
dough has doubled. Fold it twice, let it rest for an hour, and heat the oven with the pot inside.</p><p>Bake it for thirty
minutes with the lid on and fifteen without.</p></main><form><p>Sign up for our letter</p></form><footer><p>All rights
reserved</p></footer></body></html>"""]


def train(pages: DataFrame, html_col: str, sample_pages: int = SAMPLE_PAGES) -> Chain:
    """Fit the chain on a bounded sample of pages that their markup labels."""
    html = F.col(html_col).cast("string")
    marked = (pages.select(html.alias("html")).where(F.octet_length("html") <= SAMPLE_BYTES)
              .where(F.lower("html").rlike("<(article|main)[\\s>]")))
    marked = marked.where(hash_share(F.col("html"), sample_pages, marked.count()))
    rows = marked.orderBy(F.xxhash64("html"), "html").limit(sample_pages).collect()
    return fit(_examples([row["html"] for row in rows]) or _examples(BUILT_IN * 4))


def _examples(htmls: list[str]) -> list[tuple[list[list[int]], list[int]]]:
    """Pages that their markup labels, as they are and laid out anew."""
    out = []
    for seed, html in enumerate(htmls):
        found = blocks(html)
        labels = labels_by_markup(found)
        if labels:
            out.append((features(found), labels))
            out += [(features(page), y) for page, y in layouts(found, labels, seed)]
    return out


def extract_text(model: Chain, html: str | None) -> str:
    found = blocks(html)
    return "\n".join(b[0] for b, y in zip(found, model.viterbi(features(found))) if y == MAIN)


@frees
def _texts(batches: Iterator[pa.RecordBatch], model: Chain) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract_text(model, h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(texts, pa.string())],
                                         ["id", "url", "text"])


def extract(pages: DataFrame, id_col: str, url_col: str, html_col: str, model: Chain | None = None) -> DataFrame:
    """id, url, text per row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(model or train(pages, html_col))  # SLOTS x 2 floats
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(lambda b: _texts(b, shared.value), "id long, url string, text string")
