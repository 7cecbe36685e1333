"""A small fixed forest: scores that SQL can recompute, over whole tables."""

from __future__ import annotations

from clickwatch.operators.dataset import MODEL_COLUMNS
from clickwatch.operators.forest import average_path

# --- fixed values: (tree, node, feature, threshold, rows); feature -1 is a leaf -----
SPLITS = (
    (0, 0, 0, 1.21, 256), (0, 1, 1, -1.13, 220), (0, 2, -1, None, 36), (0, 3, -1, None, 30), (0, 4, -1, None, 190),
    (1, 0, 1, 0.87, 256), (1, 1, 0, -1.07, 200), (1, 2, 2, 0.93, 56), (1, 3, -1, None, 40), (1, 4, -1, None, 160),
    (1, 5, -1, None, 40), (1, 6, -1, None, 16),
    (2, 0, 2, 1.37, 256), (2, 1, 2, -1.57, 236), (2, 2, -1, None, 20), (2, 3, -1, None, 6), (2, 4, -1, None, 230),
    (3, 0, 0, 0.13, 256), (3, 1, 2, 0.71, 130), (3, 2, 1, -0.29, 126), (3, 3, -1, None, 100), (3, 4, -1, None, 30),
    (3, 5, -1, None, 2), (3, 6, -1, None, 124),
)


def _depth(node: int) -> int:
    return (node + 1).bit_length() - 1


def node_rows() -> list[tuple]:
    rows = []
    for tree, node, feature, threshold, size in SPLITS:
        if feature < 0:
            rows.append((tree, node, -1, None, -1, -1, size, _depth(node) + average_path(size)))
        else:
            rows.append((tree, node, feature, threshold, 2 * node + 1, 2 * node + 2, size, None))
    return rows


def score_sql() -> str:
    """The forest's score as a CASE expression over the model columns."""
    nodes = {(t, n): (f, thr, path) for t, n, f, thr, _, _, _, path in node_rows()}

    def walk(tree: int, node: int) -> str:
        feature, threshold, path = nodes[tree, node]
        if feature < 0:
            return f"{path!r}::double"
        return (
            f"CASE WHEN {MODEL_COLUMNS[feature]} <= {threshold!r}::double "
            f"THEN {walk(tree, 2 * node + 1)} ELSE {walk(tree, 2 * node + 2)} END"
        )

    trees = sorted({t for t, _ in nodes})
    total = " + ".join(f"({walk(t, 0)})" for t in trees)
    return f"pow(2, -({total}) / {len(trees)} / {average_path(256)!r}::double)"
