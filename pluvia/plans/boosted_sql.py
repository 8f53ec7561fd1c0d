"""The boosted trees of ``operators.boosting`` as SQL: the same aggregates level by level, unrolled.

Cuts are all values of a feature, which are what the bins hold as long as a feature has fewer values than bins
and none is rarer than a bin.
"""

from __future__ import annotations

from pluvia.operators.boosting import GAIN_DECIMALS, Booster


def _columns(features: int, alias: str = "") -> str:
    return ", ".join(f"CAST({alias}x{k} AS DOUBLE)" for k in range(features))


def boosted_ctes(name: str, base: str, booster: Booster, features: int) -> dict[str, str]:
    """Table expressions over ``base`` (id, role, y, x0, ...); models are fit on its rows of role ``train``.

    ``<name>`` has the columns of ``base`` and the prediction p, ``<name>_cuts`` one row per split.
    """
    last, out, cuts = f"{name}_f0", {}, []
    out[last] = f"SELECT *, (SELECT avg(y) FROM {base} WHERE role = 'train') AS p FROM {base}"
    for tree in range(booster.trees):
        rows = f"{name}_n{tree}_0"
        out[rows] = f"SELECT *, CAST(0 AS BIGINT) AS node FROM {last}"
        for level in range(booster.depth):
            sums, best = f"{name}_u{tree}_{level}", f"{name}_b{tree}_{level}"
            out[sums] = f"""SELECT node, feature, v, sum(g) AS g, CAST(count(*) AS DOUBLE) AS h
  FROM (SELECT node, p - y AS g, unnest(range({features})) AS feature, unnest([{_columns(features)}]) AS v FROM {rows} WHERE role = 'train')
  GROUP BY ALL"""
            gain = f"""round(0.5 * (gl * gl / (hl + {booster.ridge}) + (gt - gl) * (gt - gl) / (ht - hl + {booster.ridge})
    - gt * gt / (ht + {booster.ridge})), {GAIN_DECIMALS})"""
            out[best] = f"""SELECT node, feature, cut, gain FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, cut) AS place
  FROM (SELECT *, {gain} AS gain FROM (SELECT node, feature, v AS cut, sum(g) OVER o - g AS gl, sum(h) OVER o - h AS hl,
      sum(g) OVER a AS gt, sum(h) OVER a AS ht FROM {sums}
      WINDOW o AS (PARTITION BY node, feature ORDER BY v), a AS (PARTITION BY node, feature)))
  WHERE hl >= {booster.least} AND ht - hl >= {booster.least} AND gain > 0) WHERE place = 1"""
            after = f"{name}_n{tree}_{level + 1}"
            out[after] = f"""SELECT r.* REPLACE (CASE WHEN b.node IS NULL THEN r.node
    ELSE 2 * r.node + 1 + CAST([{_columns(features, "r.")}][b.feature + 1] >= b.cut AS BIGINT) END AS node)
  FROM {rows} r LEFT JOIN {best} b USING (node)"""
            cuts.append(f"SELECT {tree} AS tree, node, feature, cut, gain FROM {best}")
            rows = after
        last = f"{name}_f{tree + 1}"
        out[last] = f"""SELECT r.* EXCLUDE (node) REPLACE (r.p + v.value AS p) FROM {rows} r JOIN
  (SELECT node, -{booster.step} * sum(p - y) / (count(*) + {booster.ridge}) AS value FROM {rows} WHERE role = 'train' GROUP BY node) v USING (node)"""
    out[name] = f"SELECT * FROM {last}"
    out[f"{name}_cuts"] = " UNION ALL ".join(cuts)
    return out

