"""Main text of web pages: a linear-chain conditional random field over the page's leaf blocks."""

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Elements of HTML.
BLOCK_TAGS = frozenset((
    "html head body title article section nav aside header footer main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "form fieldset legend label button select option textarea blockquote pre figure figcaption address hr details summary dialog center iframe noscript"
).split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr param".split())
UNSEEN_TAGS = frozenset("template noscript svg iframe object canvas".split())
CLOSED_BY_SAME = frozenset("p li td th tr option dt dd".split())

#: Comments, scripts and styles whole; tags, in whose quoted values a ">" ends nothing; declarations.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>|<[!?][^>]*>""",
                   re.DOTALL | re.IGNORECASE)
QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.IGNORECASE)
STYLE = re.compile(r"""(?:^|\s)style\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
UNSEEN_STYLE = re.compile(r"\b(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.IGNORECASE)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
NAME_PART = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    tag: str
    ancestors: tuple[str, ...]
    names: tuple[str, ...]
    linked: int
    features: list[str] = field(default_factory=list)


def is_unseen(tag: str, attributes: str) -> bool:
    """Whether a browser shows nothing of an element, by its tag, its ``hidden`` or its own style."""
    if tag in UNSEEN_TAGS:
        return True
    style = STYLE.search(attributes)
    if style and UNSEEN_STYLE.search(style[1] or style[2] or style[3] or ""):
        return True
    return "hidden" in attributes.lower() and bool(HIDDEN.search(QUOTED.sub("=", attributes)))


def leaf_blocks(page: str) -> list[Block]:
    """The texts between the borders of block elements, in page order, with their open elements and the words of those' classes and ids.

    Inline elements and line breaks do not end a block. Comments, scripts, styles and
    elements that a browser hides have no text. Unclosed elements stay open to the end of their parent.
    """
    stack: list[tuple[str, tuple[str, ...], bool]] = []
    blocks: list[Block] = []
    held: list[str] = []
    linked = [0]

    def end_block() -> None:
        if held:
            text = SPACE.sub(" ", html.unescape("".join(held))).strip()
            if text:
                inside = [t for t, _, _ in stack]
                blocks.append(Block(text, next((t for t in reversed(inside) if t in BLOCK_TAGS), ""), tuple(inside),
                                    tuple(n for _, names, _ in stack for n in names), linked[0]))
            held.clear()
        linked[0] = 0

    def add(text: str) -> None:
        if text and not any(unseen for _, _, unseen in stack):
            held.append(text)
            if any(t == "a" for t, _, _ in stack):
                linked[0] += len(text.strip())

    at = 0
    for found in TOKEN.finditer(page):
        add(page[at:found.start()])
        at = found.end()
        tag = (found.group(3) or "").lower()
        if not tag:
            continue
        if tag in BLOCK_TAGS:
            end_block()
        elif tag == "br":
            held.append(" ")
        if found.group(2):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in VOID_TAGS and not found.group(4).endswith("/"):
            if tag in CLOSED_BY_SAME or tag in BLOCK_TAGS:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == (tag if tag in CLOSED_BY_SAME else "p"):
                        del stack[k:]
                        break
                    if stack[k][0] in BLOCK_TAGS and stack[k][0] not in CLOSED_BY_SAME:
                        break
            names = tuple(n for m in NAMED.finditer(found.group(4)) for n in NAME_PART.findall((m[1] or m[2] or m[3] or "").lower()))
            stack.append((tag, names, is_unseen(tag, found.group(4))))
    add(page[at:])
    end_block()
    return blocks


def _step(value: float, steps: tuple[float, ...]) -> int:
    return sum(value >= s for s in steps)


def describe(blocks: list[Block]) -> list[list[str]]:
    """The features of each block: its element and ancestors, the words of their classes and ids, and its text's shape."""
    out = []
    for k, block in enumerate(blocks):
        text, n = block.text, len(block.text)
        out.append([
            "bias", f"tag {block.tag}", *{f"in {t}" for t in block.ancestors if t in BLOCK_TAGS}, *{f"name {w}" for w in block.names},
            f"words {_step(text.count(' ') + 1, (2, 4, 8, 16, 40))}", f"links {_step(block.linked / n, (0.01, 0.3, 0.8))}",
            f"stops {_step(sum(map(text.count, '.!?')), (1, 2, 5))}", f"ends {text[-1] in '.!?…'}",
            f"rights {'©' in text or '(c)' in text.lower()}", f"first {k == 0}", f"last {k == len(blocks) - 1}",
        ])
    return out


class Field:
    """Linear chain over labels 0 (aside) and 1 (main text), with a weight per feature and label, and per pair of neighbours."""

    def __init__(self, features: dict[str, int]):
        self.features = features
        self.states = np.zeros((len(features) + 1, 2))
        self.moves = np.zeros((2, 2))

    def rows(self, described: list[list[str]]) -> list[np.ndarray]:
        """Features as numbers; those that training did not have share the last one, whose weight stays 0."""
        unknown = len(self.features)
        return [np.array([self.features.get(f, unknown) for f in d]) for d in described]

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.states[r].sum(axis=0) for r in rows])

    def decode(self, described: list[list[str]]) -> list[int]:
        """The most probable labels (Viterbi); of equals the first."""
        if not described:
            return []
        scores = self.scores(self.rows(described)).tolist()
        (to00, to01), (to10, to11) = self.moves.tolist()
        zero, one = scores[0]
        back = []
        for s0, s1 in scores[1:]:
            a, b, c, d = zero + to00, one + to10, zero + to01, one + to11
            back.append((int(b > a), int(d > c)))
            zero, one = max(a, b) + s0, max(c, d) + s1
        label = int(one > zero)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]

    def marginals(self, scores: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of labels as (page, block, label), and of pairs of neighbours summed over everything.

        ``scores`` has the pages' blocks one after the other, filled up to one length; ``there`` tells blocks from filling."""
        n = scores.shape[1]
        alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
        alpha[:, 0] = scores[:, 0]
        for k in range(1, n):
            onward = scores[:, k] + np.logaddexp(alpha[:, k - 1, :1] + self.moves[0], alpha[:, k - 1, 1:] + self.moves[1])
            alpha[:, k] = np.where(there[:, k, None], onward, alpha[:, k - 1])
        for k in range(n - 2, -1, -1):
            after = scores[:, k + 1] + beta[:, k + 1]
            before = np.logaddexp(self.moves[:, 0] + after[:, :1], self.moves[:, 1] + after[:, 1:])
            beta[:, k] = np.where(there[:, k + 1, None], before, 0)
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])[:, None, None]
        pairs = np.exp(alpha[:, :-1, :, None] + self.moves + (scores[:, 1:] + beta[:, 1:])[:, :, None, :] - total[..., None])
        return np.exp(alpha + beta - total), (pairs * there[:, 1:, None, None]).sum(axis=(0, 1))

    @classmethod
    def train(cls, pages: list[tuple[list[list[str]], list[int]]], epochs: int = 200, rate: float = 0.1, ridge: float = 1e-4) -> "Field":
        """Weights of the largest likelihood with a small ridge, by Adam steps over the whole set."""
        pages = [(described, labels) for described, labels in pages if described]
        made = cls({f: k for k, f in enumerate(sorted({f for described, _ in pages for d in described for f in d}))})
        longest = max(len(labels) for _, labels in pages)
        labels = np.full((len(pages), longest), -1)
        for k, (_, given) in enumerate(pages):
            labels[k, :len(given)] = given
        there = labels >= 0
        n = there.sum()
        rows = [r for described, _ in pages for r in made.rows(described)]
        flat, block = np.concatenate(rows), np.repeat(np.arange(n), [len(r) for r in rows])
        truth = np.eye(2)[labels[there]]
        both = there[:, :-1] & there[:, 1:]
        true_moves = np.zeros((2, 2))
        np.add.at(true_moves, (labels[:, :-1][both], labels[:, 1:][both]), 1)
        weights = [made.states, made.moves]
        means, squares = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, epochs + 1):
            scores = np.zeros((*labels.shape, 2))
            scores[there] = np.column_stack([np.bincount(block, made.states[flat, y], n) for y in (0, 1)])
            chances, pairs = made.marginals(scores, there)
            wrong = truth - chances[there]
            slope = np.column_stack([np.bincount(flat, wrong[block, y], len(made.states)) for y in (0, 1)])
            slope[-1] = 0
            for k, gain in enumerate((slope, true_moves - pairs)):
                gain = gain / n - ridge * weights[k]
                means[k] = 0.9 * means[k] + 0.1 * gain
                squares[k] = 0.99 * squares[k] + 0.01 * gain ** 2
                weights[k] += rate * (means[k] / (1 - 0.9 ** step)) / (np.sqrt(squares[k] / (1 - 0.99 ** step)) + 1e-8)
        return made


def labelled_pages(n_pages: int = 400, seed: int = 5) -> list[tuple[list[list[str]], list[int]]]:
    """Pages with labelled blocks, made from a grammar of the usual layouts: which container holds the article, and which of the usual asides stand where,
    in which elements and under which class names. Their text is drawn from syllables, so nothing but structure and shape can be learnt.
    """
    random = np.random.default_rng(seed)

    def one(options):
        return options[int(random.integers(len(options)))]

    def words(low: int, high: int) -> str:
        n = int(random.integers(low, high + 1))
        return " ".join("".join(one(["an", "be", "co", "de", "er", "in", "lo", "mi", "ta", "us"]) for _ in range(int(random.integers(1, 4)))) for _ in range(n))

    def sentences(low: int, high: int) -> str:
        return " ".join(words(4, 18).capitalize() + one([".", ".", ".", "!", "?"]) for _ in range(int(random.integers(low, high + 1))))

    def menu() -> str:
        links = [f'<a href="/{words(1, 1)}">{words(1, 2)}</a>' for _ in range(int(random.integers(3, 8)))]
        inner = one(["<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>", " ".join(links), "".join(f"<p>{x}</p>" for x in links)])
        return one([f"<nav>{inner}</nav>", f'<div class="{one(["menu", "nav", "navbar", "navigation", "breadcrumb", "topbar"])}">{inner}</div>', f'<ul id="{one(["menu", "nav"])}">{inner}</ul>'])

    def aside(kinds) -> str:
        name = one(kinds)
        inner = one([sentences(1, 3), f"<p>{sentences(1, 3)}</p>", f"<h3>{words(1, 4)}</h3><p>{sentences(1, 2)}</p>", words(1, 6)])
        return f'<{(t := one(["div", "div", "section", "aside", "p"]))} {one(["class", "id"])}="{name}">{inner}</{t}>'

    adverts = ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner ad"]
    notices = ["cookie", "cookie-notice", "notice", "consent", "gdpr-banner", "alert", "popup", "modal"]
    sides = ["sidebar", "related", "widget", "share", "social", "recommended", "author-box", "tags", "pagination", "newsletter", "subscribe", "promo", "trending"]

    single = ["comment", "comment", "user-comment", "reply"]
    lists = ["comments", "comments", "comments", "comment-list", "reader-comments", "replies", "responses", "discussion"]

    def comments() -> str:
        inner = lambda: one([f"<b>{words(1, 2)}</b> {sentences(1, 3)}", f"<p>{sentences(1, 3)}</p>", f"<p>{words(1, 2)}</p><p>{sentences(1, 4)}</p>", sentences(1, 3)])
        tag, name = one([("div", ' class="comment"'), ("li", ' class="comment"'), ("div", ""), ("li", ""), ("section", "")])
        each = "".join(f"<{tag}{name}>{inner()}</{tag}>" for _ in range(int(random.integers(1, 5))))
        head = one(["", f"<h3>{words(1, 3)}</h3>", f"<h2>{words(1, 2)}</h2>"])
        return f'<{(t := one(["div", "div", "section", "ul" if tag == "li" else "div"]))} {one(["class", "id"])}="{one(lists)}">{head}{each}</{t}>'

    def form() -> str:
        return f'<form action="/x"><label>{words(1, 5)}</label><input name="q"><p>{sentences(1, 2)}</p><button>{words(1, 2)}</button></form>'

    def article() -> list[str]:
        parts = [f"<{(h := one(['h1', 'h1', 'h2']))}>{words(3, 12).capitalize()}</{h}>"]
        for _ in range(int(random.integers(1, 9))):
            parts.append(one([
                *[f"<p>{sentences(1, 8)}</p>"] * 6, f"<p><b>{words(1, 4)}</b> {sentences(1, 4)}<br>", f"<p>{words(1, 8)}</p>", f"<p>{words(2, 5).capitalize()}.</p>", f"<p>{words(2, 5).capitalize()}.</p>", f"<h2>{words(2, 8).capitalize()}</h2>",
                f"<p>{sentences(1, 2)} <a href='/x'>{words(1, 3)}</a> {sentences(0, 2)}</p>", "<ul>" + "".join(f"<li>{words(2, 14)}</li>" for _ in range(3)) + "</ul>",
                f"<blockquote>{sentences(1, 3)}</blockquote>", f"<pre>{words(3, 20)}</pre>", f"<figure><figcaption>{words(3, 10)}</figcaption></figure>",
                f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>", f"<div>{sentences(1, 5)}</div>"]))
        return parts

    def made() -> tuple[str, set[int]]:
        # The article's pieces are marked by a letter that no other text has.
        main = [re.sub(r">([^<]+)", lambda m: ">" + "ƶ" + m[1] if m[1].strip() else m[0], part) for part in article()]
        for _ in range(int(random.integers(0, 3))):
            main.insert(int(random.integers(1, len(main) + 1)), one([aside(adverts), aside(sides), comments(), comments(), aside(single), form(), aside(notices)]))
        inner = "".join(main)
        body = one([f"<article>{inner}</article>"] * 3 + [f"<main>{inner}</main>", f"<main><article>{inner}</article></main>"] + [
            f'<div {one(["class", "id"])}="{one(["content", "main", "post", "article", "entry-content", "story", "text", "post-body"])}">{inner}</div>'] * 3
            + [f"<section>{inner}</section>", f"<td>{inner}</td>", f"<div>{inner}</div>"])
        before = [x for x in (menu(), f"<header><a href='/'>{words(1, 3)}</a><p>{words(2, 8)}</p></header>", aside(notices), aside(adverts), form(), f'<div id="header">{words(1, 5)}</div>') if random.random() < 0.4]
        after = [x for x in (aside(sides), comments(), form(), aside(adverts), menu(), f"<aside><h3>{words(1, 3)}</h3><p>{sentences(1, 3)}</p></aside>", aside(notices)) if random.random() < 0.35]
        foot = one([f"<footer>&copy; {words(1, 3)} &middot; {sentences(0, 2)}</footer>", f'<div class="footer"><p>{words(3, 10)}</p><p>&copy; {words(1, 4)}</p></div>', f"<footer><p>{sentences(1, 2)}</p></footer>", ""])
        return f"<html><head><title>{words(3, 9)}</title></head><body>{''.join(before)}{body}{''.join(after)}{foot}</body></html>"

    pages = []
    for _ in range(n_pages):
        blocks = leaf_blocks(made())
        labels = [int("ƶ" in b.text) for b in blocks]
        for b in blocks:
            b.text = b.text.replace("ƶ", "")
        blocks, labels = zip(*[(b, y) for b, y in zip(blocks, labels) if b.text])
        pages.append((describe(list(blocks)), list(labels)))
    return pages


def main_text(page: str | None, model: Field) -> str:
    """The blocks labelled as main text, one per line; empty for a page without text."""
    blocks = leaf_blocks(page or "")
    return "\n".join(b.text for b, y in zip(blocks, model.decode(describe(blocks))) if y)


def extract(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from its whole ``html``.

    The model is trained on ``labelled_pages`` if none is given. NULL and empty pages give an empty text; NULL ids and urls and repeated rows stay as they are. An empty table
    gives no rows.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model or Field.train(labelled_pages()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, sent.value) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(work, "page_id long, url string, text string, n_chars long")
