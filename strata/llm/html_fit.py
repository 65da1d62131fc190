"""How the weights of the main-text classifier are learned (operator 5).

Labelled blocks are made from pages that mark their parts: a block is content if it stands in
an article and nothing marks it as menu, footer, form, advert or comment. Each page is
shown in several views, in which some of these marks are gone (an ``article`` is a plain
``div``, a ``nav`` too, a class is dropped) while the labels stay, so that wording, links and
place must tell content from the rest where marks do not. Into each page a paragraph of the page
before it is put as a note beside the text, a comment, a form, ... (``ASIDES``): well written, and
no content. And the first words of its text are a page of their own, all of which is content.
Logistic regression finds the
weights with the most posterior probability, content and the rest weighing the same; the prior
is centred on ``PRIOR``, which says what a sign is taken to mean, and keeps the weight of a
sign that the pages do not show.

``html_text.WEIGHTS`` are the result for the given pages, rounded to hundredths; a test learns them again.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable

import numpy as np

from strata.llm import html_text as h

#: What the signs are taken to mean before any page is seen.
PRIOR = {"bias": 0.0, "words": 1.2, "links": -3.0, "ends": 0.6, "paragraph": 0.6, "heading": 0.4, "item": -0.5,
         "article": 3.0, "main": 2.0, "good": 1.5, "outside": -3.5, "nav": -7.0, "header": -6.0, "footer": -7.0,
         "aside": -7.0, "form": -7.0, "bad": -7.0, "comments": -9.0}
#: Labelled blocks, for each sign, that all of them together weigh as much as; steps of Newton's method.
EVIDENCE, STEPS = 10.0, 40
#: The views of a page: what is replaced, by what.
VIEWS = ([], [(r"<(/?)article\b", r"<\1div")], [(r"<(/?)(?:nav|footer|aside|header)\b", r"<\1div")],
         [(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "")],
         [(r"<(/?)(?:article|nav|footer|aside|header)\b", r"<\1div")])
#: What holds the paragraph that is put into a page, in turns.
ASIDES = ("<aside>{}</aside>", "<div class=sidebar>{}</div>", "<section id=comments>{}</section>", "<form>{}</form>",
          "<footer>{}</footer>", "<div class='related promo'>{}</div>", "<nav>{}</nav>", "<div class=comment-list><article>{}</article></div>")
MARK = "Qzx"


def labelled(pages: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Signs (a row a block, a column a sign of ``PRIOR``) and labels of the blocks of all views."""
    names = list(PRIOR)
    rows, labels = [], []

    def add(shown: str, truth: list[bool]) -> None:
        seen, hints = h.blocks(shown)
        put = [b.text.startswith(MARK) for b in seen]
        if len(seen) - sum(put) != len(truth):
            return  # a mark was all that parted two blocks
        own = iter(truth)
        for found, strange in zip(h.page_signs(seen, hints), put):
            got = dict(found)
            rows.append([got.get(n, 0.0) for n in names])
            labels.append(not strange and next(own))

    borrowed = f"{MARK} is not of this page."
    for k, page in enumerate(pages):
        found, _ = h.blocks(page)
        truth = [bool(b.flags & h.BIT["article"]) and not h._marked(b) and b.hint < 0 for b in found]
        strange = ASIDES[k % len(ASIDES)].format(f"<p>{html.escape(borrowed)}</p>")
        for view in VIEWS:
            shown = page
            for pattern, by in view:
                shown = re.sub(pattern, by, shown)
            add(shown, truth)
        add(page.replace("</h1>", "</h1>" + strange, 1), truth)
        text = [b.text for b, t in zip(found, truth) if t]
        if text:
            add(html.escape(" ".join(text[-1].split()[:2 + k % 30])), [True])
            borrowed = f"{MARK} {text[-1]}"
    return np.array(rows).reshape(-1, len(names)), np.array(labels, bool)


def fit(x: np.ndarray, y: np.ndarray) -> dict[str, float]:
    """The weights, by Newton's method."""
    prior = np.array(list(PRIOR.values()))
    w = prior.copy()
    if not len(y) or y.all() or not y.any():
        return dict(PRIOR)
    share = np.where(y, 0.5 / y.mean(), 0.5 / (~y).mean()) * EVIDENCE / len(y) * len(PRIOR)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + (w - prior)
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return {n: round(float(v), 2) for n, v in zip(PRIOR, w)}
