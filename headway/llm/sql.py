"""DuckDB SQL for the operators that are sums and digests from end to end (11 and 13)."""

from __future__ import annotations

#: Levels written out: enough for 16**6 rows of a source and 16**4 sources.
SOURCE_LEVELS, TOP_LEVELS = 6, 4

#: crc32 of the bytes of a decimal number, bit by bit.
CRC = """
CREATE_CRC AS (
  SELECT doc_id, xor(list_reduce(
    list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce(
      range(8), lambda r, step: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, xor(crc, byte)),
    CAST(4294967295 AS BIGINT)), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
)"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, nodes: str, levels: int) -> list[str]:
    """CTEs {name}{k}: (tree, idx, n, digest) of level k, and {name}p{k}: its nodes with their siblings."""
    out = [f"{name}0 AS MATERIALIZED ({nodes})"]
    for k in range(levels):
        run = "PARTITION BY tree, idx // 16 ORDER BY idx ROWS BETWEEN"
        out.append(f"""{name}p{k} AS MATERIALIZED (
  SELECT tree, idx, CASE WHEN n = 1 THEN idx ELSE idx // 16 END AS parent, n > 1 AS folds,
    coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS MATERIALIZED (
  SELECT tree, idx // 16 AS idx, any_value(n + 15) // 16 AS n,
    CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest
  FROM {name}{k} GROUP BY tree, idx // 16)""")
    return out


def merkle_manifest() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ctes = [CRC.strip().replace("CREATE_CRC", "crcs")]
    ctes.append(f"""leaves AS MATERIALIZED (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN crc % 5 = 0 THEN {_leaf(f"translate(text, '{upper}', '{upper.lower()}')")} END AS changed
  FROM documents LEFT JOIN crcs USING (doc_id))""")
    ctes.append("""sources AS MATERIALIZED (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM documents))""")
    ctes.append("""placed AS MATERIALIZED (
  SELECT d.*, s.tree, row_number() OVER (PARTITION BY s.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY s.tree) AS n
  FROM leaves d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source)""")
    ctes += _tree("a", "SELECT tree, idx, n, leaf AS digest FROM placed", SOURCE_LEVELS)
    tops = f"SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, digest FROM a{SOURCE_LEVELS}"
    ctes += _tree("b", tops, TOP_LEVELS)
    ctes.append("f0 AS (SELECT doc_id, leaf, tree, tree AS own, idx AS at, '' AS proof, coalesce(changed, leaf) AS node FROM placed)")
    steps = [("a", k) for k in range(SOURCE_LEVELS)] + [("b", k) for k in range(TOP_LEVELS)]
    for i, (name, k) in enumerate(steps):
        tree, at = ("0", "f.tree") if (name, k) == ("b", 0) else ("f.own", "f.at")
        ctes.append(f"""f{i + 1} AS MATERIALIZED (
  SELECT f.doc_id, f.leaf, f.tree, p.tree AS own, p.parent AS at, f.proof || p.l || p.r AS proof,
    CASE WHEN p.folds THEN sha256(p.l || f.node || p.r) ELSE f.node END AS node
  FROM f{i} f JOIN {name}p{k} p ON p.tree = {tree} AND p.idx = {at})""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT f.doc_id, f.leaf, s.digest AS subroot, r.digest AS root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = r.digest AS verified
FROM f{len(steps)} f JOIN a{SOURCE_LEVELS} s ON s.tree = f.tree CROSS JOIN (SELECT digest FROM b{TOP_LEVELS}) r"""


def vector_codes(rounds: int = 4) -> str:
    ctes = ["""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
    """parts AS MATERIALIZED (
  SELECT row, pos, list_slice(v, pos * (len(v) // 4) + 1, (pos + 1) * (len(v) // 4)) AS part FROM kept, range(4) t(pos))""",
    "book0 AS MATERIALIZED (SELECT pos, row - 1 AS entry, part FROM parts WHERE row <= 256)"]
    for k in range(rounds + 1):
        ctes.append(f"""near{k} AS MATERIALIZED (
  SELECT row, pos, any_value(p.part) AS part, min(struct_pack(
    d := list_dot_product(p.part, p.part) - 2 * list_dot_product(p.part, b.part) + list_dot_product(b.part, b.part), e := b.entry)) AS best
  FROM parts p JOIN book{k} b USING (pos) GROUP BY row, pos)""")
        if k < rounds:
            ctes.append(f"""sums{k} AS (
  SELECT pos, entry, list(mean ORDER BY d) AS part FROM (
    SELECT pos, best.e AS entry, d, floor(sum(part[d]) / count(*)) AS mean
    FROM near{k}, unnest(range(1, len(part) + 1)) t(d) GROUP BY pos, best.e, d) GROUP BY pos, entry)""")
            ctes.append(f"book{k + 1} AS MATERIALIZED (SELECT pos, entry, coalesce(s.part, b.part) AS part FROM book{k} b LEFT JOIN sums{k} s USING (pos, entry))")
    ctes.append(f"""codes AS MATERIALIZED (
  SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY pos) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY row)""")
    ctes.append(f"""spelled AS (
  SELECT sha256(string_agg(array_to_string(list_transform(part, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM book{rounds})""")
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (row) CROSS JOIN spelled"""
