"""SQL that gives the rows of the queries it can express, over the same tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10 = rf"""
WITH docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, w, least(len(w), 10) AS width
  FROM (SELECT item_id, coalesce({_WORDS}, []) AS w FROM benchmark) WHERE len(w) > 0
),
spans AS (
  SELECT DISTINCT item_id, width, array_to_string(list_slice(w, i, i + width - 1), ' ') AS span
  FROM (SELECT item_id, width, w, unnest(range(1, len(w) - width + 2)) AS i FROM items)
),
windows AS (
  SELECT doc_id, i, width, array_to_string(list_slice(w, i, i + width - 1), ' ') AS span
  FROM (
    SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
    FROM docs, (SELECT DISTINCT width FROM spans)
  )
),
met AS (SELECT doc_id, i, width, item_id FROM windows JOIN spans USING (width, span)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM met) GROUP BY doc_id
),
ids AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS listed
  FROM met GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

_TERMS = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = rf"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce({_TERMS}, []) AS terms FROM documents),
items AS (SELECT row_number() OVER () AS item_row, item_id, coalesce({_TERMS}, []) AS terms FROM benchmark),
totals AS (SELECT count(*) AS big_n, sum(len(terms))::BIGINT AS big_l FROM docs WHERE len(terms) > 0),
tfs AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs, totals GROUP BY term
),
sizes AS (SELECT row_id, doc_id, 100 - 25 + ((25 * len(terms)::BIGINT * big_n) // big_l) AS m FROM docs, totals WHERE len(terms) > 0),
asked AS (SELECT item_row, item_id, term, count(*) AS times FROM (SELECT item_row, item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
scored AS (
  SELECT item_row, item_id, doc_id, row_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (row_id) GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_row ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

OP5 = r"""
WITH docs AS (
  SELECT doc_id, source, size,
    0.1::DOUBLE + 0.9::DOUBLE * least(lettered::DOUBLE / greatest(size, 1)::DOUBLE, 1.0::DOUBLE) AS quality,
    (('0x' || substr(md5('5|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u
  FROM (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
      coalesce(len(regexp_extract_all(text, '(?:^|[\x20\x09-\x0D])\pL')), 0) AS lettered
    FROM documents
  )
),
sizes AS (
  SELECT source, source_size, (2 * source_size)::DOUBLE AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source)
),
levels AS (
  SELECT *, cap / weight < (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS capped
  FROM sizes
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
  SELECT source, source_size, CASE WHEN capped THEN cap ELSE least(
    (1.5::DOUBLE * sum(source_size) OVER () - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())
      / nullif(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (), 0) * weight, cap) END AS target
  FROM levels
),
drawn AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (
    PARTITION BY source ORDER BY -ln(u) / quality, doc_id, size, quality
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs
),
taken AS (
  SELECT doc_id, size, source_size, target, before,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
  FROM drawn JOIN targets ON drawn.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (epochs + CASE WHEN target > epochs * source_size AND before + size / 2.0 <= target - epochs * source_size
    THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM taken
"""

OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
sized AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS text_chars,
    length(role) + length(regexp_replace(role, '[^\\#<:\n]', '', 'g')) AS role_chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + role_chars + 2 + text_chars + 9) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


def _op6(damping: float = 0.85, steps_most: int = 200, even: float = 1e-4) -> str:
    """Two personalised ranks over the host graph, as sums over walks of each length."""
    host = f"translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}')"

    def fits(name: str, prefix: str) -> str:
        return f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{prefix}')"

    def rank(name: str, verdict: str, src: str, dst: str) -> list[str]:
        return [
            f"{name}_out AS (SELECT {src} AS host, sum(n) AS total, coalesce(sum(n) FILTER (WHERE src = dst), 0) AS own FROM edges GROUP BY ALL)",
            f"{name}_share AS (SELECT {src} AS src, {dst} AS dst, {damping}::DOUBLE * n / total / (1 - {damping}::DOUBLE * own / total) AS share "
            f"FROM edges JOIN {name}_out ON host = {src} WHERE src <> dst)",
            f"{name}_walk AS (SELECT host, 0 AS step, n / sum(n) OVER () AS mass FROM seeds WHERE verdict = '{verdict}' "
            f"UNION ALL SELECT dst, step + 1, sum(mass * share) FROM {name}_walk JOIN {name}_share ON src = host "
            f"WHERE step < {steps_most} GROUP BY dst, step + 1)",
            f"{name}_rank AS (SELECT host, sum(mass) * any_value((1 - {damping}::DOUBLE) / "
            f"(1 - {damping}::DOUBLE * coalesce(own / total, 0))) AS rank "
            f"FROM {name}_walk LEFT JOIN {name}_out USING (host) GROUP BY host)",
        ]

    steps = [
        f"rows AS (SELECT page_id, html, coalesce({host}, '') AS host, "
        "coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages)",
        "ruled AS (SELECT page_id, host, path, CASE "
        f"WHEN {fits('example.org', '/en/1')} THEN 'example.org/en/1' WHEN {fits('example.org', '/es/')} THEN 'example.org/es/' "
        f"WHEN {fits('com', '/fr/')} THEN 'com/fr/' WHEN {fits('com', '/de/')} THEN 'com/de/' "
        f"WHEN {fits('org', '/')} THEN 'org/' END AS rule FROM rows)",
        "decided AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS verdict "
        "FROM ruled)",
        "seeds AS (SELECT host, verdict, count(*)::DOUBLE AS n FROM decided WHERE verdict IS NOT NULL AND host <> '' GROUP BY ALL)",
        "links AS (SELECT host AS src, unnest(regexp_extract_all(html, "
        "'(?i)\\bhref\\s*=\\s*[\"'']?([^\"''\\s>]+)', 1)) AS link FROM rows WHERE host <> '')",
        "ends AS (SELECT src, CASE WHEN regexp_matches(link, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//') THEN "
        f"translate(regexp_extract(CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END, "
        f"'^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') ELSE src END AS dst FROM links)",
        "edges AS (SELECT src, dst, count(*)::DOUBLE AS n FROM ends WHERE dst <> '' GROUP BY ALL)",
        *rank("t", "allow", "src", "dst"),
        *rank("d", "block", "dst", "src"),
        f"ranks AS (SELECT host, sum(t) AS t, sum(d) AS d FROM (SELECT host, rank AS t, 0 AS d FROM t_rank "
        "UNION ALL SELECT host, 0, rank FROM d_rank) GROUP BY host)",
    ]
    return "WITH RECURSIVE " + ",\n".join(steps) + (
        "\nSELECT page_id, host, path, rule, CASE WHEN verdict IS NOT NULL THEN verdict "
        f"WHEN d > t * (1 + {even}) THEN 'block' ELSE 'allow' END AS verdict FROM decided LEFT JOIN ranks USING (host)"
    )


OP6 = _op6()


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text by its definition: bit by bit, polynomial EDB88320."""
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    bit = "xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"list_reduce(list_prepend(xor(acc, code), [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: {bit})"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda acc, code: {byte}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _op13() -> str:
    """Trees level by level, proofs by looking the neighbours up, folds step by step."""

    def leaf(n_chars: str) -> str:
        return f"sha256({' || '.join(_field(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"

    def tree(name: str, start: str) -> str:
        """Nodes (grp, level, idx, n, digest) of every level; n nodes stand on it."""
        return (
            f"{name} AS ({start} UNION ALL SELECT grp, level + 1, idx // 2, (any_value(n) + 1) // 2, "
            f"sha256(string_agg(digest, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY grp, level, idx // 2)"
        )

    def steps(of: str, nodes: str, rank: str, shift: str) -> str:
        """The neighbour of every leaf of ``of`` on each level below the top."""
        return (
            f"SELECT leaf_id, {shift} + own.level AS step, own.idx & 1 AS digit, beside.digest AS sibling "
            f"FROM {of} JOIN {nodes} own ON own.grp IS NOT DISTINCT FROM {of}.grp_{nodes} AND own.idx = {of}.{rank} >> own.level "
            f"AND own.n > 1 LEFT JOIN {nodes} beside ON beside.grp IS NOT DISTINCT FROM own.grp AND beside.level = own.level "
            "AND beside.idx = xor(own.idx, 1)"
        )

    crc = _crc32("CAST(doc_id AS VARCHAR)")
    parts = [
        f"leaves AS (SELECT doc_id, lang, {leaf('n_chars')} AS leaf, "
        f"CASE WHEN {crc} % 7 = 0 THEN {leaf('CAST(n_chars AS HUGEINT) + 1')} ELSE {leaf('n_chars')} END AS start FROM documents)",
        "ranked AS (SELECT *, row_number() OVER () AS leaf_id, "
        "row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, "
        "count(*) OVER (PARTITION BY lang) AS n FROM leaves)",
        tree("low", "SELECT lang AS grp, 0 AS level, rank AS idx, n, leaf AS digest FROM ranked"),
        "subroots AS (SELECT grp, digest, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS rank, count(*) OVER () AS n "
        "FROM low WHERE n = 1)",
        tree("high", "SELECT 'all' AS grp, 0 AS level, rank AS idx, n, digest FROM subroots"),
        "asked AS (SELECT leaf_id, doc_id, leaf, start, lang AS grp_low, 'all' AS grp_high, ranked.rank AS low_rank, "
        "subroots.rank AS high_rank, subroots.digest AS subroot FROM ranked JOIN subroots ON grp IS NOT DISTINCT FROM lang)",
        f"proof AS ({steps('asked', 'low', 'low_rank', '0')} UNION ALL {steps('asked', 'high', 'high_rank', '1000')})",
        "listed AS (SELECT leaf_id, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256, "
        "list({'digit': digit, 'sibling': sibling} ORDER BY step) AS path FROM proof GROUP BY leaf_id)",
        "folded AS (SELECT asked.leaf_id, 0 AS done_steps, start AS digest, path FROM asked LEFT JOIN listed USING (leaf_id) "
        "UNION ALL SELECT leaf_id, done_steps + 1, sha256(CASE WHEN path[done_steps + 1].sibling IS NULL THEN digest "
        "WHEN path[done_steps + 1].digit = 1 THEN path[done_steps + 1].sibling || digest ELSE digest || path[done_steps + 1].sibling END), path "
        "FROM folded WHERE done_steps < coalesce(len(path), 0))",
        "done AS (SELECT leaf_id, digest AS folded_root FROM folded WHERE done_steps = coalesce(len(path), 0))",
    ]
    return "WITH RECURSIVE " + ",\n".join(parts) + (
        "\nSELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, "
        "folded_root = root AS verified FROM asked JOIN done USING (leaf_id) LEFT JOIN listed USING (leaf_id), "
        "(SELECT digest AS root FROM high WHERE n = 1)"
    )


ORACLES: dict[str, str] = {
    "op3_chat": OP3,
    "op6_urls": OP6,
    "op5_mixing": OP5,
    "op10_decontamination": OP10,
    "op11_lexical": OP11,
    "op13_merkle": _op13(),
}
