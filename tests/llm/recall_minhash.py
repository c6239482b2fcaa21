"""Recall of the near-duplicate groups against all links: python tests/llm/recall_minhash.py SF_DIR [SIZE].

All links between different shingle sets are found by an inverted index over every
shingle, exactly, and compared with the operator's groups: a link is kept if both of its
documents have the same component. Prints links, links lost, and groups that differ.
"""

import os
import sys
import tempfile
from collections import Counter, defaultdict

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from vantle.llm import minhash  # noqa: E402
from vantle.session import local_session, ship_package  # noqa: E402


def all_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of places whose sets have at least the similarity, through postings of each set's rarest shingles.

    Two sets of similarity t share one of the first (1 - t) * size + 1 shingles of each in
    any common order, so postings need no others, and nothing is missed.
    """
    often = Counter()
    for s in sets:
        often.update(s.tolist())
    posted: dict[int, list[int]] = defaultdict(list)
    links = []
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    for k in order:
        s = sets[k]
        n = len(s)
        head = sorted(s.tolist(), key=lambda x: (often[x], x))[: n - -(-percent * n // 100) + 1]
        met = {j for x in head for j in posted[x]}
        for j in met:
            m = len(sets[j])
            if 100 * m >= percent * n:
                common = len(np.intersect1d(sets[j], s, assume_unique=True))
                if 100 * common >= percent * (n + m - common):
                    links.append((j, k))
        for x in head:
            posted[x].append(k)
    return links


def main(folder: str, size: int) -> None:
    shared = tempfile.mkdtemp(prefix="vantle-recall-")
    spark = local_session(8, 16, **{"spark.checkpoint.dir": f"file://{shared}/shared", "spark.sql.warehouse.dir": f"file://{shared}/warehouse"})
    ship_package(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    component = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, size).collect()}
    first: dict[bytes, tuple[int, np.ndarray]] = {}
    for r in docs.orderBy("doc_id").toLocalIterator():
        s = minhash.shingle_set(r["text"] or "", size)
        if len(s):
            first.setdefault(s.tobytes(), (r["doc_id"], s))
    ids, sets = [i for i, _ in first.values()], [s for _, s in first.values()]
    links = all_links(sets, 80)
    lost = [(ids[a], ids[b]) for a, b in links if component[ids[a]] != component[ids[b]]]
    print(f"{folder}: {len(sets)} different sets, {len(links)} links between them, {len(lost)} lost, recall {1 - len(lost) / max(1, len(links)):.6f}", lost[:5])
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 2)
