"""HTML extraction: a tree-structured graphical model over the page's nodes.

Every node of the DOM tree is article text or not. A node's own look (its
kind, the words in its class, id and role, how its text is made) gives a
unary potential; each parent and child are coupled by a potential that
depends on the child's kind. Both are learned from labelled pages by
pseudo-likelihood: a node's label is regressed on its look and on its
neighbours' labels. On a tree, sum-product message passing is exact: one
pass from the leaves up, one from the root down, and every node has its
marginal. Text of nodes with a marginal of one half or more is kept, in page
order. Scripts, styles, titles, text areas and inner frames are no nodes;
pictures, formulas, objects and lists of choices are nodes like any other.

Messages are passed for a whole batch of pages at once, level by level. Work
is per row: no shuffle, no state. The training pages
(``gapscope.llm.labelled_pages``) are a fixed number; others can be passed.

Defined results: null, empty and tag-free sources without text give an empty
text; broken markup is read as far as it goes (unclosed elements end with
their parent, stray end tags are ignored, a quote that is never closed is an
ordinary character, a tag that the page ends in goes with what is in it); the
time a page takes is in proportion to its length; repeated rows give equal texts;
columns that clash with the added ones are replaced; an empty table gives an
empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gapscope.llm.common import read, with_columns
from gapscope.llm.dom import KINDS, N_FEATURES, OTHER, Page, assembled, features, parse
from gapscope.llm.labelled_pages import LABEL, labelled_pages

KEEP_AT = 0.5
RIDGE, STEPS = 1e-4, 60
#: Pages whose nodes share a round of messages; characters of HTML handled at a time.
PAGES, CHARS = 256, 4_000_000
#: Labelled pages made, and the share of them whose names mislead.
TRAINING, ODD = 2000, 0.4
#: Nodes whose features are held at a time.
ROWS = 8192


@dataclass
class Model:
    """Half log-odds of a node's look, and the coupling of a node of each kind to its parent (Ising form)."""

    look: np.ndarray
    coupling: np.ndarray

    def marginals(self, rows: np.ndarray, parent: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """P(article text) of each node of a forest; ``parent`` is -1 at roots and always earlier."""
        return self.beliefs(rows @ self.look, parent, kind)

    def beliefs(self, field: np.ndarray, parent: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """``marginals`` from each node's own half log-odds, in time and memory of the number of nodes whatever their depth."""
        field = field.copy()
        pull = np.tanh(self.coupling[kind])
        below = levels(parent)[1:]
        up = np.zeros(len(parent))
        for nodes in reversed(below):
            up[nodes] = np.arctanh(pull[nodes] * np.tanh(field[nodes]))
            np.add.at(field, parent[nodes], up[nodes])
        for nodes in below:
            above = field[parent[nodes]] - up[nodes]
            field[nodes] += np.arctanh(pull[nodes] * np.tanh(above))
        return 1 / (1 + np.exp(-2 * np.clip(field, -300, 300)))


def levels(parent: np.ndarray) -> list[np.ndarray]:
    """The nodes at each distance from their root, roots first."""
    depth: list[int] = []
    for p in parent.tolist():
        depth.append(depth[p] + 1 if p >= 0 else 0)
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth))[:-1]) if depth else [order]


def forest(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parents, kinds, first node of each page) of all pages' nodes together."""
    starts = np.concatenate([[0], np.cumsum([len(p.parent) for p in pages])]).astype(np.int64)
    parent = np.array([q + s if q >= 0 else -1 for p, s in zip(pages, starts.tolist()) for q in p.parent], np.int64)
    kind = np.array([KINDS.get(t, OTHER) for p in pages for t in p.tag], np.int64)
    return parent, kind, starts


def feature_blocks(pages: list[Page]) -> Iterator[np.ndarray]:
    """Features of all pages' nodes in order, at most ``ROWS`` nodes at a time."""
    rows = chain.from_iterable(map(features, pages))
    while block := list(islice(rows, ROWS)):
        yield np.array(block, np.float64)


def true_labels(page: Page) -> np.ndarray:
    """+1 or -1 per node: that of the nearest labelled block at or above it, else that of most text below it."""
    n = len(page.parent)
    given = list(page.label)
    for i in range(1, n):
        if given[i] < 0 and page.parent[i] >= 0 and given[page.parent[i]] >= 0:
            given[i] = given[page.parent[i]]
    votes = [page.chars[i] * (2 * given[i] - 1) if given[i] >= 0 else 0 for i in range(n)]
    for i in range(n - 1, 0, -1):
        votes[page.parent[i]] += votes[i]
    return np.array([2 * given[i] - 1 if given[i] >= 0 else (1 if votes[i] > 0 else -1) for i in range(n)], np.float64)


def fit(sources: list[str] | None = None, label: str = LABEL) -> Model:
    """Learn both potentials by pseudo-likelihood (ridge, Newton's method) from pages whose blocks carry ``label``."""
    pages = [parse(s, label) for s in (labelled_pages(TRAINING, odd=ODD) if sources is None else sources)]
    rows = np.concatenate([np.empty((0, N_FEATURES)), *feature_blocks(pages)])
    parent, kind, _ = forest(pages)
    y = np.concatenate([true_labels(p) for p in pages])
    near = np.zeros((len(y), OTHER + 1))  # sum of neighbours' labels, by the kind of the edge's child
    child = np.flatnonzero(parent >= 0)
    np.add.at(near, (child, kind[child]), y[parent[child]])
    np.add.at(near, (parent[child], kind[child]), y[child])
    x = np.concatenate([rows, near], 1)
    w = np.zeros(x.shape[1])
    target = (y + 1) / 2
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -300, 300)))
        gradient = x.T @ (p - target) / len(y) + RIDGE * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    # two labels that agree never count against each other
    return Model(w[: rows.shape[1]] / 2, np.clip(w[rows.shape[1]:] / 2, 0.0, 3.0))


def main_texts(sources: list[str], model: Model) -> list[str]:
    out: list[str] = []
    for at in range(0, len(sources), PAGES):
        pages = [parse(s) for s in sources[at: at + PAGES]]
        parent, kind, starts = forest(pages)
        field = np.concatenate([block @ model.look for block in feature_blocks(pages)])
        keep = model.beliefs(field, parent, kind) >= KEEP_AT
        out += [assembled(p, keep[a:b]) for p, a, b in zip(pages, starts[:-1], starts[1:])]
    return out


def extract(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points), without the source."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(html))
            texts: list[str] = []
            held: list[str] = []
            chars = 0
            for value in column:
                held.append(value.as_py() or "")
                chars += len(held[-1])
                if chars > CHARS:
                    texts += main_texts(held, shared.value)
                    held, chars = [], 0
            texts += main_texts(held, shared.value)
            kept = batch.select([n for n in batch.schema.names if n != html])
            yield with_columns(kept, {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    base = pages.select(*[c for c in pages.columns if c not in ("text", "n_chars") or c == html])
    fields = [f for f in base.schema.fields if f.name != html]
    return base.mapInArrow(run, T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"), fit()).select("page_id", "url", "text", "n_chars")


QUERIES = {"op3_html_extract": op3_html_extract}
