"""Checking SQL of the operators that SQL can express, in the checking engine's dialect."""

from __future__ import annotations

from factorfall.llm import chat_format, exact_topk, host_rules, pivot_dedup, secret_scan, source_divergence, source_mixing, url_filters

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _url_filters() -> str:
    def digits(key: str, at: int) -> str:
        return f"('0x' || substr(md5({key}), {at}, 6))::INT"

    day = f"DATE '{url_filters.FIRST_DAY}'"
    exempting = ", ".join(f"'{name}'" for name in url_filters.EXEMPTING)
    return rf"""
    WITH found AS MATERIALIZED (SELECT page_id, url,
        nullif(regexp_replace(regexp_replace(lower(regexp_extract(url, '{url_filters._HOST}', 1)), '^.*@', ''), ':[0-9]*$', ''), '') AS host,
        nullif(regexp_extract(url, '{url_filters._SEGMENT}', 1), '') AS segment,
        ({day} + {digits("page_id || ':' || url", 1)} % {url_filters._DAYS})::DATE AS fetched_on FROM pages),
    labels AS (SELECT DISTINCT host, segment, string_split(host, '.') AS l FROM found WHERE host IS NOT NULL),
    patterns AS MATERIALIZED (
      SELECT host, segment, 'domain' AS kind, k AS depth, array_to_string(l[len(l) - k + 1 : len(l)], '.') AS pattern
      FROM (SELECT *, unnest(range(1, len(l) + 1)) AS k FROM labels)
      UNION ALL SELECT host, segment, 'prefix', len(l) + 1, host || '/' || segment FROM labels WHERE segment IS NOT NULL),
    numbered AS (SELECT kind, pattern, kind || ':' || pattern || ':' || k AS key
      FROM (SELECT DISTINCT kind, pattern FROM patterns WHERE depth > 1), range(5) r(k)),
    entries AS (SELECT DISTINCT ['adult', 'allow', 'malware', 'spam'][1 + {digits("key", 7)} % 4] AS list, kind, pattern,
        ({day} + {digits("key", 13)} % {url_filters._DAYS})::DATE AS dated,
        CASE WHEN {digits("key", 19)} % 4 < 3 THEN 'add' ELSE 'remove' END AS action
      FROM numbered WHERE {digits("key", 1)} % 3 = 0),
    spans AS (SELECT *, coalesce(lead(dated) OVER (PARTITION BY list, kind, pattern ORDER BY dated, action), DATE '{url_filters.FAR}') AS until
      FROM entries),
    active AS (SELECT f.*, depth, s.list, s.pattern FROM (SELECT DISTINCT host, segment, fetched_on FROM found) f
      JOIN patterns p ON p.host = f.host AND p.segment IS NOT DISTINCT FROM f.segment
      JOIN spans s ON s.kind = p.kind AND s.pattern = p.pattern AND action = 'add' AND fetched_on >= dated AND fetched_on < until),
    best AS (SELECT *, count(*) OVER (PARTITION BY host, segment, fetched_on) AS n,
        row_number() OVER (PARTITION BY host, segment, fetched_on ORDER BY depth DESC, list NOT IN ({exempting}), list, pattern) AS nth FROM active)
    SELECT page_id, url, f.host, f.fetched_on::VARCHAR AS fetched_on, coalesce(n, 0)::BIGINT AS n_active,
      list || ':' || pattern AS decided_by, coalesce(list NOT IN ({exempting}), false) AS blocked
    FROM found f LEFT JOIN best b ON nth = 1 AND b.host = f.host AND b.segment IS NOT DISTINCT FROM f.segment AND b.fetched_on = f.fetched_on"""


def _source_mixing() -> str:
    m, top = source_mixing, 1 << source_mixing.GRID
    entropy = f"(SELECT ln(sum(pow(p, {{a}}))) - {{a}} * sum(pow(p, {{a}}) * ln(p)) / sum(pow(p, {{a}})) FROM shares)"
    at_mid, at_one = entropy.format(a=f"(((lo + hi) // 2) / {top}.0::DOUBLE)"), entropy.format(a="1.0::DOUBLE")
    target = f"(SELECT {m.ENTROPY_RATIO} * ln(count(*)) FROM shares)"
    key = "coalesce(doc_id::VARCHAR, '-')"
    block_order = f"md5('{m.SEED}:' || {{e}} || ':' || coalesce(source, '-') || ':' || block)"
    doc_order = f"md5('{m.SEED}:' || {{e}} || ':' || {key})"
    return rf"""
    WITH RECURSIVE t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, len({_WORDS})::BIGINT AS tokens FROM documents),
    s AS MATERIALIZED (SELECT source, sum(tokens)::BIGINT AS source_tokens, least(ceil(count(*) / {m.BLOCK_DOCS}.0)::BIGINT, {m.MOST_BLOCKS}) AS n_blocks
      FROM t GROUP BY source),
    shares AS MATERIALIZED (SELECT source_tokens AS n, source_tokens / (SELECT sum(source_tokens) FROM s)::DOUBLE AS p FROM s WHERE source_tokens > 0),
    halves(step, lo, hi) AS (
      SELECT 0, CASE WHEN {at_one} >= {target} THEN {top} ELSE 0 END::BIGINT, {top}::BIGINT
      UNION ALL SELECT step + 1, CASE WHEN reached THEN mid ELSE lo END, CASE WHEN reached THEN hi ELSE mid END
      FROM (SELECT step, lo, hi, (lo + hi) // 2 AS mid, {at_mid} >= {target} AS reached FROM halves WHERE hi - lo > 1)),
    grid AS (SELECT lo, (SELECT ln(max(n)::DOUBLE / min(n)) FROM shares) AS spread FROM halves ORDER BY step DESC LIMIT 1),
    power AS MATERIALIZED (SELECT CASE WHEN (SELECT count(*) FROM shares) < 2 THEN 1.0::DOUBLE
      WHEN spread > 0 AND (1 - lo / {top}.0::DOUBLE) * spread > ln({m.REPEAT_LIMIT})
      THEN least({top}, ceil((1 - ln({m.REPEAT_LIMIT}) / spread) * {top})) / {top}.0::DOUBLE ELSE lo / {top}.0::DOUBLE END AS a FROM grid),
    raised AS (SELECT *, CASE WHEN source_tokens > 0 THEN pow(source_tokens / (SELECT sum(source_tokens) FROM s)::DOUBLE, (SELECT a FROM power)) ELSE 0 END AS x FROM s),
    weighted AS MATERIALIZED (SELECT *, round(x / (SELECT sum(x) FROM raised), 9) AS weight FROM raised),
    budgeted AS (SELECT *, round(weight * ceil((SELECT max(source_tokens / weight) FROM weighted WHERE source_tokens > 0)), 0)::BIGINT AS budget FROM weighted),
    plan AS MATERIALIZED (SELECT source AS p_source, n_blocks, weight, CASE WHEN source_tokens > 0 THEN budget // source_tokens ELSE 1 END AS epochs,
      CASE WHEN source_tokens > 0 THEN budget % source_tokens ELSE 0 END AS cut_tokens FROM budgeted),
    placed AS (SELECT *, ('0x' || substr(md5('block:' || {key}), 1, 12))::BIGINT % n_blocks AS block
      FROM t JOIN plan ON source IS NOT DISTINCT FROM p_source),
    ordered AS MATERIALIZED (SELECT *, {block_order.format(e="epochs")} AS b_order, {doc_order.format(e="epochs")} AS d_order FROM placed),
    running AS (SELECT r, sum(tokens) OVER (PARTITION BY source ORDER BY b_order, d_order) AS after, cut_tokens FROM ordered WHERE cut_tokens > 0),
    drawn AS (SELECT o.*, unnest(range(0, epochs + coalesce((after <= o.cut_tokens)::INT, 0))) AS epoch FROM ordered o LEFT JOIN running USING (r))
    SELECT doc_id, source, tokens, weight, epoch::BIGINT AS epoch, block::BIGINT AS block, {block_order.format(e="epoch")} AS block_order,
      {doc_order.format(e="epoch")} AS doc_order FROM drawn"""


def _host_rules() -> str:
    m = host_rules
    flags = ", ".join(f"({rule}) AS {name}" for name, rule in m.RULES.items())
    sums = ", ".join(f"sum({r}::INT)::DOUBLE AS f_{r}" for r in m.RULES)
    rates, watched, rejected = [], [], []
    for r in m.RULES:
        p, total = f"(SELECT sum(f_{r}) / sum(n) FROM hosts)", "(SELECT sum(n) FROM hosts)::DOUBLE"
        between = f"((SELECT sum(f_{r} * f_{r} / n) FROM hosts) - {total} * {p} * {p})"
        spread, k = f"({p} * (1 - {p}))", "((SELECT count(*) FROM hosts) - 1)"
        room = f"({spread} * ({total} - (SELECT sum(n::DOUBLE * n) FROM hosts) / {total} - {k}))"
        rho = f"CASE WHEN {room} > 0 THEN ({between} - {spread} * {k}) / {room} ELSE 0 END"
        strength = f"(1 / least(greatest({rho}, 1e-6), 1 - 1e-6) - 1)"
        rates.append(f"(f_{r} + {p} * {strength}) / (n + {strength}) AS rate_{r}, {p} AS p_{r}")
        watched.append(f"({r} AND rate_{r} > {m.WATCH} AND rate_{r} > {m.WATCH_TIMES} * p_{r})")
        rejected.append(f"rate_{r} > {m.REJECT}")
    return rf"""
    WITH w AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t, {_WORDS} AS words FROM documents),
    told AS (SELECT r, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM w),
    triples AS (SELECT r, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM told WINDOW o AS (PARTITION BY r ORDER BY i)),
    windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS times FROM triples WHERE c IS NOT NULL),
    repeated AS (SELECT r, count(DISTINCT p) AS k FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE times > 1) GROUP BY r),
    counted AS (SELECT w.r, doc_id, host, len(words)::BIGINT AS n_words,
        coalesce(list_sum([length(x) for x in words]), 0)::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
        coalesce(k, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN repeated USING (r)),
    numbers AS (SELECT * EXCLUDE (lines), len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines FROM counted),
    flagged AS MATERIALIZED (SELECT *, {flags} FROM numbers),
    hosts AS MATERIALIZED (SELECT host, count(*) AS n, {sums} FROM flagged GROUP BY host),
    shrunk AS (SELECT host AS h, {", ".join(rates)} FROM hosts)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words OR repetitive AS base_failed,
      {" OR ".join(rejected)} AS host_rejected,
      NOT (few_words OR repetitive) AND NOT ({" OR ".join(rejected)}) AND NOT ({" OR ".join(watched)}) AS kept
    FROM flagged JOIN shrunk ON host IS NOT DISTINCT FROM h"""


def _exact_topk() -> str:
    return f"""
    WITH v AS (SELECT vec_id, [floor(x::DOUBLE * {exact_topk.SCALE}) for x in embedding] AS x FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    u AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM v),
    scores AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
      FROM u q JOIN u c ON len(q.x) = len(c.x) AND q.r <> c.r WHERE q.vec_id % 50 = 0)
    SELECT query_id, nth::INT AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS nth FROM scores) WHERE nth <= {exact_topk.K}"""


def _chat_format() -> str:
    pattern = _quoted(chat_format._FIRST + r"(\\*)" + chat_format._CONTROL)

    def escaped(text: str) -> str:
        return f"regexp_replace({text}, {pattern}, '\\1\\\\\\2\\3', 'g')"

    frame = len(chat_format.START) + len(chat_format.END) + 2
    role = escaped("replace(replace(role, '\\', '\\\\'), chr(10), '\\n')")
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, k, CASE k WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(k)),
    u AS (SELECT *, sum({frame} + length({role}) + length({escaped("text")})) OVER (PARTITION BY conv_id {order} ROWS UNBOUNDED PRECEDING) AS chars,
      lead(role) OVER (PARTITION BY conv_id {order}) IS NULL AS last FROM t)
    SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum(chars) FILTER (role = 'assistant' OR last)::BIGINT AS formatted_chars
    FROM u GROUP BY conv_id"""


def _secret_scan() -> str:
    m = secret_scan
    kinds = []
    for i, (kind, (pattern, group, least)) in enumerate({**m.STRONG, **m.WEAK}.items()):
        p = _quoted(pattern)
        kinds.append(f"""
      SELECT r, '{kind}' AS kind, {i} AS nth, '{m.ROLE[kind]}' AS role, {kind in m.WEAK} AS weak, i,
        (list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in found[1:i - 1]]), 0))::BIGINT AS a,
        length(found[i])::BIGINT AS n
      FROM (SELECT r, string_split_regex(t, {p}) AS gaps, regexp_extract_all(t, {p}, 0) AS found, regexp_extract_all(t, {p}, {group}) AS checked,
        unnest(range(1, len(found) + 1)) AS i FROM d) WHERE length(checked[i]) >= {least}""")
    text = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, nth, b)"
    counts = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in m.STRONG)
    return f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    every AS MATERIALIZED (SELECT *, a + n AS b FROM ({" UNION ALL ".join(kinds)})),
    parts AS MATERIALIZED (SELECT * FROM every e WHERE NOT weak OR NOT EXISTS (
      SELECT 1 FROM every s WHERE NOT s.weak AND s.r = e.r AND s.a = e.a AND s.b = e.b)),
    told AS (SELECT * FROM parts p WHERE NOT weak OR EXISTS (SELECT 1 FROM parts o WHERE o.r = p.r AND o.role <> p.role
      AND (o.role = 'secret' OR p.role = 'secret') AND o.a <= p.b + {m.SCOPE} AND o.b >= p.a - {m.SCOPE})),
    joined AS (SELECT r, {text} AS spans, {text} FILTER (NOT weak) AS base,
      {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in m.STRONG)} FROM told GROUP BY r)
    SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN joined USING (r)"""


def _pivot_dedup() -> str:
    return f"""
    WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, [x::DOUBLE for x in embedding] AS x,
        label IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([1 for x in embedding if x <> 0]) > 0 AS ok
      FROM embeddings),
    links AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.label = b.label AND len(a.x) = len(b.x) AND a.r <> b.r
      WHERE a.ok AND b.ok AND list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= {pivot_dedup.COSINE}),
    reach(a, b) AS (SELECT r, r FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
    named AS (SELECT reach.a, min(vec_id) AS component_id FROM reach JOIN v ON r = b GROUP BY reach.a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM v JOIN named ON a = r LEFT JOIN (SELECT a AS la, count(*) AS n FROM links GROUP BY a) ON la = r"""


def _source_divergence() -> str:
    m = source_divergence

    def share(n: str) -> str:
        return f"(1 + ({m.SCALE}::HUGEINT * ({n} + {m.PRIOR})) // (total + {m.PRIOR} * size))::BIGINT"

    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all({low}, '{m.TERM}') AS terms FROM documents),
    told AS MATERIALIZED (SELECT r, lang, source, unnest(terms) AS term FROM d),
    kept AS MATERIALIZED (SELECT lang, term FROM told GROUP BY lang, term HAVING count(DISTINCT r) >= {m.MIN_DOCS}),
    sizes AS (SELECT lang, count(*)::HUGEINT AS size FROM kept GROUP BY lang),
    counts AS MATERIALIZED (SELECT lang, source, term, count(*)::HUGEINT AS n FROM told JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS MATERIALIZED (SELECT g.*, coalesce(size, 0) AS size, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g
      LEFT JOIN sizes USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) USING (lang, source)),
    p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, {share("coalesce(n, 0)")} AS p
      FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    q AS (SELECT lang, term, {share("n")} AS q FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL)
      JOIN (SELECT lang, sum(total) AS total, max(size) AS size FROM groups GROUP BY lang) USING (lang)),
    apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    found AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
      UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found)
    WHERE part = 'pair' OR rank <= {m.TOP_TERMS}"""


def checking_sql() -> dict[str, str]:
    return {
        "op1_url_filters": _url_filters(),
        "op2_source_mixing": _source_mixing(),
        "op3_host_rules": _host_rules(),
        "op5_exact_topk": _exact_topk(),
        "op7_chat_format": _chat_format(),
        "op8_secret_scan": _secret_scan(),
        "op12_pivot_dedup": _pivot_dedup(),
        "op13_source_divergence": _source_divergence(),
    }
