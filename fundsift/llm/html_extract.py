"""Main text of web pages by minimum-cut labelling of their blocks.

A trained classifier prices each block as content or boilerplate; these prices, and what
element names say, are the capacities to the two terminals. Neighbouring blocks, and blocks
below one element, are joined by smoothness edges. The minimum cut labels all blocks.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundsift.llm.html_blocks import FEATURES, Page

#: Pages whose blocks train the classifier: at most so many, chosen by a hash of the page id.
SAMPLE = 2_000

#: Prior weights, where training has nothing to say, and the strength of that prior.
PRIOR = dict.fromkeys(FEATURES, 0.0) | {
    "one": -1.5, "log_words": 1.0, "link_share": -4.0, "ends_sentence": 1.0, "content_name": 1.0, "boilerplate_name": -8.0, "only_links": -2.0,
}
RIDGE = 10.0
STEPS = 12

#: Nats that being inside an article, or inside navigation and the like, is worth.
INSIDE, OUTSIDE = 4.0, 12.0

#: Capacities of smoothness edges: between neighbours, divided by their distance in the DOM,
#: and between the next blocks below one element.
NEAR, SIBLING = 1.0, 0.5


def min_cut(to_source: np.ndarray, to_sink: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Which nodes stay with the source in a minimum cut; ``edges`` hold in both directions."""
    n = len(to_source)
    source, sink = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def link(a: int, b: int, there: float, back: float) -> None:
        head[a].append(len(to))
        head[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i in range(n):
        # What runs straight through a node is cut in any case.
        both = min(to_source[i], to_sink[i])
        if to_source[i] > both:
            link(source, i, float(to_source[i] - both), 0.0)
        elif to_sink[i] > both:
            link(i, sink, float(to_sink[i] - both), 0.0)
    for a, b, weight in edges:
        link(a, b, weight, weight)
    least = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            node = queue.popleft()
            for e in head[node]:
                if room[e] > least and level[to[e]] < 0:
                    level[to[e]] = level[node] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return np.array(level[:n]) >= 0
        at = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if room[e] <= least)
                node = to[path[k] ^ 1]
                del path[k:]
            while at[node] < len(head[node]):
                e = head[node][at[node]]
                if room[e] > least and level[to[e]] == level[node] + 1:
                    path.append(e)
                    node = to[e]
                    break
                at[node] += 1
            else:
                if not path:
                    break
                node = to[path.pop() ^ 1]
                at[node] += 1


def smoothness(page: Page) -> list[tuple[int, int, float]]:
    edges, last = [], {}
    for k, block in enumerate(page.blocks):
        if k:
            edges.append((k - 1, k, NEAR / (1 + page.distance(page.blocks[k - 1].element, block.element))))
        parent = page.elements[block.element].parent
        if parent in last and last[parent] != k - 1:
            edges.append((last[parent], k, SIBLING))
        last[parent] = k
    return edges


def content(page: Page, weights: np.ndarray) -> np.ndarray:
    """Which blocks are content."""
    says, rows = page.evidence()
    odds = rows @ weights + np.where(says > 0, INSIDE, 0.0) - np.where(says < 0, OUTSIDE, 0.0)
    odds = np.clip(odds, -20, 20)
    return min_cut(np.logaddexp(0, odds), np.logaddexp(0, -odds), smoothness(page))


def extract_text(source: str | None, weights: np.ndarray) -> str:
    page = Page(source)
    if not page.blocks:
        return ""
    keep = content(page, weights)
    return "\n".join(b.text for b, kept in zip(page.blocks, keep, strict=True) if kept)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for source in batch["html"]:
            says, rows = Page(source.as_py()).evidence()
            used = np.flatnonzero(says)
            features = pa.FixedSizeListArray.from_arrays(pa.array(rows[used].ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(says[used] > 0), features], ["content", "features"])


def train(pages: DataFrame, key: str = "page_id", html: str = "html") -> np.ndarray:
    """Weights of a logistic regression on blocks whose element names tell their label.

    Blocks inside ``article`` or ``main`` count as content, those inside navigation, footers,
    asides and forms as boilerplate; element names are no features. At most ``SAMPLE`` pages
    are used, the first by a hash of their key and then of their HTML. With no such block the prior
    stays. Null and repeated keys, and null HTML, are as good as others; an empty table gives the prior.
    """
    share = min(1.0, SAMPLE / 2 / max(pages.count(), 1))
    place = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    chosen = pages.select(F.col(html).alias("html"), place.alias("place")).filter(F.col("place") <= share * 2**32)
    sample = chosen.orderBy("place", F.xxhash64("html"), "html").limit(SAMPLE).select("html")
    found = sample.mapInArrow(_examples, "content boolean, features array<double>").toPandas()
    prior = np.array([PRIOR[f] for f in FEATURES])
    if not len(found):
        return prior
    x, y = np.stack(found["features"].to_numpy()), found["content"].to_numpy(np.float64)
    weights = prior.copy()
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + RIDGE * (weights - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(prior))
        weights = weights - np.linalg.solve(curve, slope)
    return weights


def extract(spark: SparkSession, html: Column, weights: np.ndarray) -> Column:
    """The main text: content blocks in page order, joined by line feeds.

    Character references are decoded and white space inside a block becomes one space. Null
    or empty HTML, and pages without content, give an empty text. Row by row: repeated
    rows, ties and other columns do not matter.
    """
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([extract_text(v.as_py(), shared.value) for v in batch], pa.string())

    return run(html)
