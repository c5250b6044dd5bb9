"""The model of main text: a conditional random field over the blocks of a page, trained on generated pages.

The log odds of a block are linear in its features and, given the labels of its neighbours (1 or -1), in their
sum over each kind of edge, so costs of labels and of edges stand on one scale. Pages to fit on come from a seeded
generator of layouts (landmark elements, named containers, bare containers), with blocks labelled by construction.
"""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np

#: Generated pages that the model is fitted on; its seed and the weight of the penalty on squares.
PAGES, SEED, PENALTY = 500, 83, 2.0
#: Characters that mark a generated block as article or not.
ARTICLE, OTHER = "", ""

#: Names of containers in generated pages.
ARTICLE_NAMES = "post entry article story content post-content article-body entry-content main main-content story__body post_text".split()
OTHER_NAMES = {
    "nav": "nav navbar menu main-menu site-nav navigation topnav_menu breadcrumbs".split(),
    "header": "header site-header masthead banner top-banner".split(),
    "footer": "footer site-footer page-footer legal copyright".split(),
    "aside": "sidebar left-sidebar sidebar-right widget widget-area related related-posts recommended".split(),
    "notice": "cookie-notice cookies alert popup notice newsletter-signup consent modal overlay".split(),
    "ad": "ad ads advert advertisement sponsored promo ad-slot banner-ad".split(),
    "comments": "comments comment-list user-comments replies disqus feedback".split(),
    "form": "search login signup subscribe".split(),
    "share": "share sharing social share-buttons social-links".split(),
}
#: Names that say nothing, though a part of them may seem to.
NEUTRAL_NAMES = "wrapper container row col inner has-sidebar no-ads page layout grid share-price ad-free section box with-comments".split()


class Pages:
    """Generated pages, every block of which begins with its mark."""

    def __init__(self, rng: random.Random):
        self.rng = rng
        self.syllables = ["".join(rng.choice(x) for x in ("bdfgklmnprstvz", "aeiou", "nrst ")).strip() for _ in range(60)]

    def word(self) -> str:
        return "".join(self.rng.choice(self.syllables) for _ in range(self.rng.randint(1, 3)))

    def words(self, a: int, b: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(a, b)))

    def prose(self, a: int, b: int) -> str:
        out = []
        for _ in range(self.rng.randint(a, b)):
            out.append((self.words(1, 8) + self.rng.choice(["", ", " + self.words(2, 6)])).capitalize() + self.rng.choice("...!?"))
        return " ".join(out)

    def text(self) -> str:
        """Text of an article's paragraph, of any quality."""
        kind = self.rng.random()
        if kind < 0.7:
            return self.prose(1, 9)
        if kind < 0.8:
            return self.words(1, 3).capitalize() + self.rng.choice(["", "."])
        if kind < 0.87:
            return self.prose(1, 4).upper()
        return self.rng.choice([" | ", " ", "!!! "]).join(self.word() for _ in range(self.rng.randint(1, 60)))

    def attributes(self, kind: str, named: bool, own: list[str] | None = None) -> str:
        names = list(own or (OTHER_NAMES[kind] if kind in OTHER_NAMES else [])) if named else []
        out = [self.rng.choice(names)] if names else []
        if self.rng.random() < 0.3:
            out.append(self.rng.choice(NEUTRAL_NAMES))
        self.rng.shuffle(out)
        return f' {self.rng.choice(["class", "class", "id"])}="{" ".join(out)}"' if out else ""

    def box(self, tag: str, kind: str, inside: str) -> str:
        """A container that is known by its element, by its name, or by neither."""
        if self.style == "landmarks" and self.rng.random() < 0.9:
            return f"<{tag}{self.attributes(kind, self.rng.random() < 0.4)}>{inside}</{tag}>"
        return f"<div{self.attributes(kind, self.style != 'bare')}>{inside}</div>"

    def links(self, mark: str, a: int, b: int, tag: str = "li") -> str:
        items = "".join(f'<{tag}><a href="/{self.word()}">{mark}{self.words(1, 5)}</a></{tag}>' for _ in range(self.rng.randint(a, b)))
        return f"<ul>{items}</ul>" if tag == "li" else items

    def other(self, kind: str) -> str:
        r, o = self.rng, OTHER
        known = self.style != "bare"
        prose = f"<{(tag := r.choice(['p', 'div']))}>{o}{self.prose(1, 3)}</{tag}>" if known else f"<div>{o}{self.words(1, 4)}</div>"
        if kind == "nav":
            texts = "".join(f"<li>{o}{self.words(1, 4)}</li>" for _ in range(r.randint(2, 6)))
            return self.box("nav", kind, r.choice([self.links(o, 2, 9, r.choice(["li", "li", "div"]))] * 3 + [texts, prose, o + self.prose(1, 2)]) if known else self.links(o, 2, 9))
        if kind == "header":
            return self.box("header", kind, f"<h1>{o}{self.words(1, 3)}</h1>" * r.randint(0, 1) + (prose if known else "") + self.links(o, 1, 5) * r.randint(0, 1))
        if kind == "footer":
            line = f"<p>{o}&copy; {r.randint(1990, 2030)} {self.words(1, 4)}{r.choice(['', '.', '. All rights reserved.'])}</p>"
            return self.box("footer", kind, r.choice([line, line + self.links(o, 1, 6), prose if known else line, f"{o}&copy; {self.prose(1, 2)}"]))
        if kind == "aside":
            return self.box("aside", kind, f"<h3>{o}{self.words(1, 3)}</h3>" * r.randint(0, 1) + r.choice([self.links(o, 2, 8), prose if known else self.links(o, 2, 8)]))
        if kind == "form":
            return f"<form{self.attributes(kind, known and r.random() < 0.3)}><label>{o}{self.words(1, 3)}</label><input><button>{o}{self.words(1, 2)}</button></form>"
        if kind == "comments":
            each = "".join(f"<div><p>{o}{self.prose(1, 3)}</p></div>" for _ in range(r.randint(1, 5)))
            return f"<{(tag := r.choice(['section', 'div']))}{self.attributes(kind, True)}><h2>{o}{self.words(1, 2)}</h2>{each}</{tag}>"
        if kind == "hidden":
            return f'<div {r.choice(["hidden", "aria-hidden=true"])}><p>{o}{self.prose(1, 4)}</p></div>'
        if kind == "share":
            return f"<div{self.attributes(kind, True)}>{self.links(o, 2, 5, 'div')}</div>"
        return f"<div{self.attributes(kind, True)}>{r.choice([prose, o + self.prose(1, 3)]) if known else o + self.words(1, 5)}</div>"

    def article(self) -> str:
        r, a = self.rng, ARTICLE
        parts = [f"<h1>{a}{r.choice([self.words(2, 9).capitalize(), self.prose(1, 3)])}</h1>"] * (r.random() < 0.85)
        for _ in range(r.choice([1, 2, 3, 5, 8, 12])):
            kind = r.random()
            if kind < 0.72:
                parts.append(f"<p>{a}{self.text()}" + "</p>" * (r.random() < 0.8))
            elif kind < 0.8:
                parts.append(f"<h{(n := r.randint(2, 4))}>{a}{self.words(1, 6).capitalize()}</h{n}>")
            elif kind < 0.84:
                parts.append(f"<blockquote>{a}{self.text()}</blockquote>")
            elif kind < 0.89:
                parts.append("<ul>" + "".join(f"<li>{a}{self.words(1, 12)}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif kind < 0.91 and self.style != "bare":
                parts.append(self.links(a, 1, 5))
            elif kind < 0.94:
                parts.append(f"<pre>{a}{self.words(3, 30)}</pre>")
            elif kind < 0.97:
                parts.append("<table>" + "".join(f"<tr><td>{a}{self.word()}</td><td>{a}{r.randint(1, 999)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            else:
                parts.append(f"<figure><img><figcaption>{a}{self.prose(1, 2)}</figcaption></figure>")
        if self.style != "bare":
            for kind in ("ad", "form", "share", "aside", "hidden", "comments", "nav", "footer"):
                if r.random() < 0.12:
                    parts.insert(r.randint(1, len(parts)), self.other(kind))
        inside = "".join(parts)
        if self.style == "landmarks":
            tag = r.choice(["article", "article", "main"])
            return f"<{tag}{self.attributes('', r.random() < 0.4, ARTICLE_NAMES)}>{inside}</{tag}>"
        return f"<div{self.attributes('', self.style == 'names', ARTICLE_NAMES)}>{inside}</div>"

    def page(self) -> str:
        r = self.rng
        self.style = r.choice(["landmarks", "landmarks", "names", "names", "bare"])
        before = [k for k in ("header", "nav", "notice", "ad", "form") if r.random() < 0.6]
        after = [k for k in ("aside", "comments", "nav", "footer") if r.random() < (0.75 if k == "footer" else 0.4) and not (self.style == "bare" and k == "comments")]
        r.shuffle(before)
        parts = [*map(self.other, before), self.article(), *map(self.other, after)]
        if r.random() < 0.2:
            k = len(before)
            parts[k : k + 1] = [f"<div{self.attributes('', False)}>{parts[k]}</div>"]
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 3)}</title></head><body{self.attributes('', False)}>{''.join(parts)}</body></html>"


class Model:
    """Weights of a block's features, and the capacity of each kind of edge."""

    def __init__(self, weights: np.ndarray, edges: np.ndarray):
        self.weights, self.edges = weights, edges


def logistic(x: np.ndarray, y: np.ndarray, offset: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Weights of the features x by Newton steps, for log odds that begin at offset."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(offset + x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def couplings(near: np.ndarray, y: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Weights of the sums of neighbours' labels beside the classifier's log odds; one that would be negative is 0, as a cut needs."""
    out, used = np.zeros(near.shape[1]), np.ones(near.shape[1], bool)
    while used.any():
        out[used] = logistic(near[:, used], y, offset)
        out[~used] = 0
        if (out >= 0).all():
            break
        used &= out >= 0
    return out


def trained(read: Callable, link: Callable, cut: Callable, kinds: int, pages: int = PAGES, seed: int = SEED) -> Model:
    """The model of generated pages, that `read` cuts into blocks, `link` joins by edges and `cut` labels; the same on every machine but for rounding.

    The classifier is fitted to the blocks one by one, the edges to what it leaves open, given the neighbours'
    true labels. Those are not known when pages are labelled, so that edges would be trusted too much: their common
    scale is the one, out of powers of 2, with which the cut errs least on further generated pages.
    """
    make = Pages(random.Random(seed))
    found = [read(make.page()) for _ in range(pages)]
    truth = [np.array([ARTICLE in b.text for b in page], np.float64) for page in found]
    near = []
    for page, y in zip(found, truth, strict=True):
        sums = np.zeros((len(page), kinds))
        for i, j, kind in link(page):
            sums[i, kind] += 2 * y[j] - 1
            sums[j, kind] += 2 * y[i] - 1
        near.append(sums)
    x, y = np.array([b.features for page in found for b in page]), np.concatenate(truth)
    weights = logistic(x, y, np.zeros(len(y)))
    edges = couplings(np.concatenate(near), y, x @ weights)
    more = [read(make.page()) for _ in range(pages)]
    truth = [[ARTICLE in b.text for b in page] for page in more]

    def errors(scale: float) -> int:
        known = Model(weights, edges * scale)
        return sum(a != b for page, y in zip(more, truth, strict=True) for a, b in zip(cut(page, known), y, strict=True))

    return Model(weights, edges * min((2.0**-k for k in range(8)), key=errors))
