"""DuckDB SQL equivalents of the stand-in queries (the correctness oracle)."""

from __future__ import annotations

from kenning import config

ORACLE: dict[str, str] = {}

MENTIONS = ("m AS (SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS category, "
            "json_extract_string(props, '$.k') AS value, ts FROM events)")
COUNTS = "c AS (SELECT user_id, category, value, count(*) AS frequency FROM m GROUP BY ALL)"
MODAL = ("md AS (SELECT user_id, day AS modal_day FROM (SELECT user_id, day, row_number() OVER "
         "(PARTITION BY user_id ORDER BY n DESC, day ASC) AS rn FROM (SELECT user_id, CAST(ts AS DATE) AS day, "
         "count(*) AS n FROM m GROUP BY ALL)) WHERE rn = 1)")
TITLE = ("array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
         "lambda r: upper(r[1]) || lower(r[2:])), '')")


def _step_sql(step, d):
    a = f"CAST({step.a!r} AS DOUBLE)"
    if step.form == "log10":
        return f"{a} * log10({d})"
    if step.form == "ln":
        return f"{a} * ln({d})"
    if step.form == "sqrt":
        return f"{a} * sqrt({d})"
    return f"{a} * (ln(CAST({step.ref_days} AS DOUBLE)) - ln({d}))"


def decay_sql(freq: str, days: str, schedule) -> str:
    d = f"CAST(greatest({days}, 1) AS DOUBLE)"
    parts = []
    for s in schedule:
        e = _step_sql(s, d)
        parts.append(f"ELSE {e}" if s.max_days is None else f"WHEN {d} <= {float(s.max_days)} THEN {e}")
    case = "CASE " + " ".join(parts) + " END"
    return f"CAST(ceil(round({freq} * exp({case}), 9)) AS BIGINT)"


DAYS = "date_diff('day', md.modal_day, DATE '2024-02-01')"


def aged(schedule_name: str, src: str = "m", name: str = "p") -> str:
    """CTEs c_<name>, md_<name>, <name> (aged profile) over mention CTE ``src``."""
    sched = config.DECAY_SCHEDULES[schedule_name]
    return (f"c_{name} AS (SELECT user_id, category, value, count(*) AS frequency FROM {src} GROUP BY ALL), "
            f"md_{name} AS (SELECT user_id, day AS modal_day FROM (SELECT user_id, day, row_number() OVER "
            f"(PARTITION BY user_id ORDER BY n DESC, day ASC) AS rn FROM (SELECT user_id, CAST(ts AS DATE) AS day, "
            f"count(*) AS n FROM {src} GROUP BY ALL)) WHERE rn = 1), "
            f"{name} AS (SELECT c.user_id, c.category, c.value, c.frequency, md.modal_day, "
            f"CAST(date_diff('day', md.modal_day, DATE '2024-02-01') AS BIGINT) AS days, "
            f"{decay_sql('c.frequency', DAYS, sched)} AS decay_frequency "
            f"FROM c_{name} c LEFT JOIN md_{name} md USING (user_id))")


ORACLE["mention_counts"] = f"WITH {MENTIONS}, {COUNTS} SELECT * FROM c"
ORACLE["modal_day"] = f"WITH {MENTIONS}, {MODAL} SELECT * FROM md"
for _s in ("v1", "v2", "v3"):
    ORACLE[f"decay_{_s}"] = f"WITH {MENTIONS}, {aged(_s)} SELECT * FROM p"

RANK = ("r AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id, category ORDER BY frequency DESC, "
        "value ASC) AS BIGINT) AS rank FROM c)")
ORACLE["rank_tags"] = (f"WITH {MENTIONS}, {COUNTS}, {RANK} "
                       "SELECT *, printf('TAG_%s_%04d', category, rank) AS sk FROM r")
ORACLE["top_k_interests"] = (f"WITH {MENTIONS}, {COUNTS}, {RANK} "
                             "SELECT *, printf('TAG_%s_%04d', category, rank) AS sk FROM r WHERE rank <= 3")


def _mm(x, lo, hi, low=0.0):
    std = f"coalesce(({x} - {lo}) / nullif({hi} - {lo}, 0), 0)"
    return std if low == 0.0 else f"({std} * CAST({1.0 - low!r} AS DOUBLE) + CAST({low!r} AS DOUBLE))"


def weights_sql(rows_cte: str, people: str, categories,
                columns: str = "user_id, category, value, frequency, decay_frequency, entityName, userName") -> str:
    cats = ", ".join(f"'{c}'" for c in categories)
    named = f"(category = '{people}' AND userName IS NOT NULL)"
    return (
        f"k AS (SELECT * FROM {rows_cte} WHERE category IN ({cats})), "
        "pop AS (SELECT entityName, CAST(sum(frequency) AS BIGINT) AS lookup_freq, "
        "CAST(sum(decay_frequency) AS BIGINT) AS lookup_decay_freq FROM k WHERE entityName IS NOT NULL GROUP BY 1), "
        "j AS (SELECT k.*, pop.lookup_freq, pop.lookup_decay_freq, o.lookup_freq AS own_f, "
        f"o.lookup_decay_freq AS own_df FROM k LEFT JOIN pop USING (entityName) LEFT JOIN pop o "
        f"ON k.category = '{people}' AND k.userName = o.entityName), "
        f"b AS (SELECT *, sqrt(CAST(lookup_freq + CASE WHEN {named} THEN coalesce(own_f, frequency) ELSE frequency END AS DOUBLE)) AS t_, "
        "ln(CAST(frequency AS DOUBLE)) AS s_, "
        f"sqrt(CAST(lookup_decay_freq + CASE WHEN {named} THEN coalesce(own_df, decay_frequency) ELSE decay_frequency END AS DOUBLE)) AS dt_, "
        "ln(CAST(decay_frequency AS DOUBLE)) AS ds_ FROM j), "
        "s1 AS (SELECT min(s_) AS s_lo, max(s_) AS s_hi, min(t_) AS t_lo, max(t_) AS t_hi, min(ds_) AS ds_lo, "
        "max(ds_) AS ds_hi, min(dt_) AS dt_lo, max(dt_) AS dt_hi FROM b), "
        f"w AS (SELECT b.*, CAST(1.2 AS DOUBLE) * {_mm('s_', 's_lo', 's_hi', 0.1)} + {_mm('t_', 't_lo', 't_hi', 0.1)} AS w_, "
        f"CAST(1.2 AS DOUBLE) * {_mm('ds_', 'ds_lo', 'ds_hi', 0.1)} + {_mm('dt_', 'dt_lo', 'dt_hi', 0.1)} AS dw_ FROM b, s1), "
        "s2 AS (SELECT min(w_) AS w_lo, max(w_) AS w_hi, min(dw_) AS dw_lo, max(dw_) AS dw_hi FROM w) "
        f"SELECT {columns}, lookup_freq, "
        f"lookup_decay_freq, round({_mm('w_', 'w_lo', 'w_hi')}, 3) AS weight, "
        f"round({_mm('dw_', 'dw_lo', 'dw_hi')}, 3) AS d_weight FROM w, s2")


ORACLE["interest_weights"] = (
    f"WITH {MENTIONS}, {aged('v2')}, "
    f"rows_ AS (SELECT user_id, category, value, frequency, decay_frequency, {TITLE.format(x='value')} AS entityName, "
    "user_id AS userName FROM p), "
    + weights_sql("rows_", "signup", ("view", "click", "purchase", "signup", "error")))

ORACLE["category_fold"] = (
    f"WITH {MENTIONS}, {COUNTS} SELECT user_id, CASE category WHEN 'click' THEN 'view' WHEN 'purchase' THEN 'signup' "
    "ELSE category END AS category, value, frequency, CASE category WHEN 'signup' THEN 'Mention' "
    "WHEN 'purchase' THEN 'Mail' END AS entityLabel FROM c "
    "WHERE (CASE category WHEN 'click' THEN 'view' WHEN 'purchase' THEN 'signup' ELSE category END) "
    "IN ('view', 'signup', 'error')")

ORACLE["popularity_by_id"] = (
    f"WITH {MENTIONS}, {aged('v2')} SELECT 'USER_' || value AS nameToId, CAST(sum(frequency) AS BIGINT) AS lookup_freq, "
    "CAST(sum(decay_frequency) AS BIGINT) AS lookup_decay_freq FROM p GROUP BY 1")

ORACLE["profile_merge"] = (
    f"WITH {MENTIONS}, ms AS (SELECT * FROM m WHERE ts < TIMESTAMP '2024-01-16 00:00:00'), "
    "mn AS (SELECT * FROM m WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'), "
    f"{aged('v2', 'ms', 'ps')}, {aged('v2', 'mn', 'pn')} "
    "SELECT coalesce(ps.user_id, pn.user_id) AS user_id, coalesce(ps.category, pn.category) AS category, "
    "coalesce(ps.value, pn.value) AS value, "
    "CAST(coalesce(ps.frequency, 0) + coalesce(pn.frequency, 0) AS BIGINT) AS frequency, "
    "CAST(coalesce(ps.decay_frequency, 0) + coalesce(pn.decay_frequency, 0) AS BIGINT) AS decay_frequency, "
    "CASE WHEN ps.frequency IS NOT NULL AND pn.frequency IS NOT NULL THEN 'both' "
    "WHEN ps.frequency IS NOT NULL THEN 'stored' ELSE 'new' END AS origin "
    "FROM ps FULL OUTER JOIN pn ON ps.user_id = pn.user_id AND ps.category = pn.category AND ps.value = pn.value")


def _completed_side(src):
    return (f"c{src} AS (SELECT p.user_id, category, coalesce(CASE WHEN category = 'signup' THEN done END, p.value) AS value, "
            f"sum(frequency) AS frequency, sum(decay_frequency) AS decay_frequency FROM {src} p LEFT JOIN done USING (user_id, value) GROUP BY 1, 2, 3)")


ORACLE["profile_merge_completed"] = (
    f"WITH {MENTIONS}, ms AS (SELECT * FROM m WHERE ts < TIMESTAMP '2024-01-16 00:00:00'), "
    "mn AS (SELECT * FROM m WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'), "
    f"{aged('v2', 'ms', 'ps')}, {aged('v2', 'mn', 'pn')}, "
    "names AS (SELECT user_id, value FROM ps WHERE category = 'signup' UNION SELECT user_id, value FROM pn WHERE category = 'signup'), "
    "done AS (SELECT user_id, value, string_agg(y, ' ' ORDER BY y) AS done FROM (SELECT a.user_id, a.value, b.value AS y "
    "FROM names a JOIN names b ON a.user_id = b.user_id AND (starts_with(b.value, a.value) OR (NOT contains(a.value, ' ') AND "
    "ends_with(b.value, a.value))) QUALIFY length(b.value) = max(length(b.value)) OVER (PARTITION BY a.user_id, a.value)) GROUP BY 1, 2), "
    f"{_completed_side('ps')}, {_completed_side('pn')} "
    "SELECT coalesce(s.user_id, n.user_id) AS user_id, coalesce(s.category, n.category) AS category, coalesce(s.value, n.value) AS value, "
    "CAST(coalesce(s.frequency, 0) + coalesce(n.frequency, 0) AS BIGINT) AS frequency, "
    "CAST(coalesce(s.decay_frequency, 0) + coalesce(n.decay_frequency, 0) AS BIGINT) AS decay_frequency, "
    "CASE WHEN s.frequency IS NOT NULL AND n.frequency IS NOT NULL THEN 'both' WHEN s.frequency IS NOT NULL THEN 'stored' ELSE 'new' END AS origin "
    "FROM cps s FULL OUTER JOIN cpn n ON s.user_id = n.user_id AND s.category = n.category AND s.value = n.value")


# ---------------------------------------------------------------- conversations
MSG = ("msg AS (SELECT CAST(conv_id AS VARCHAR) AS conversation_id, turn, CAST(conv_id AS VARCHAR) || '-' || "
       "CAST(turn AS VARCHAR) AS message_id, role AS sender, text AS body FROM conversations)")
NB = ("nb AS (SELECT m.*, p.sender AS prev_sender, n.sender AS next_sender FROM msg m "
      "LEFT JOIN msg p ON p.conversation_id = m.conversation_id AND p.turn = m.turn - 1 "
      "LEFT JOIN msg n ON n.conversation_id = m.conversation_id AND n.turn = m.turn + 1)")
FIRST = ("f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY turn) AS rn "
         "FROM msg) WHERE rn = 1)")


def hash_int_sql(*parts, salt):
    s = " || '|' || ".join([f"'{salt}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"CAST(('0x' || substr(sha256({s}), 1, 8)) AS BIGINT)"


def distinct_sql(l):
    """Order-preserving distinct (first occurrence kept), like Spark's array_distinct."""
    return f"list_filter({l}, lambda x, i: list_position({l}, x) = i)"


def nonnull_sql(*cols):
    return f"list_filter([{', '.join(cols)}], lambda x: x IS NOT NULL)"


ORACLE["first_message"] = f"WITH {MSG}, {FIRST} SELECT conversation_id, turn, sender, body, 'chat-message' AS type FROM f"
ORACLE["message_counts"] = (f"WITH {MSG} SELECT conversation_id, arg_min(sender, turn) AS sender, "
                            "count(body) AS num_messages FROM msg GROUP BY 1")
ORACLE["replies_only"] = (f"WITH {MSG}, {FIRST} SELECT m.conversation_id, m.turn, m.sender, m.body FROM msg m "
                          "ANTI JOIN f ON f.conversation_id = m.conversation_id AND f.turn = m.turn")
ORACLE["nested_replies"] = (
    f"WITH {MSG}, {FIRST}, r AS (SELECT m.* FROM msg m ANTI JOIN f USING (conversation_id, turn)) "
    "SELECT f.conversation_id, f.turn AS message_turn, f.sender AS message_sender, "
    "CAST(count(r.turn) AS BIGINT) AS num_replies, "
    "coalesce(string_agg(CAST(r.turn AS VARCHAR), ',' ORDER BY r.turn), '') AS reply_turns, "
    "coalesce(string_agg(r.sender, ',' ORDER BY r.turn), '') AS reply_senders "
    "FROM f LEFT JOIN r USING (conversation_id) GROUP BY f.conversation_id, f.turn, f.sender")
_CH = "[" + ", ".join(f"'{c}'" for c in config.CHANNEL_NAMES) + "]"
ORACLE["channel_assign"] = (
    f"WITH {MSG}, c AS (SELECT conversation_id, max({_CH}[CAST(({hash_int_sql('conversation_id', 'turn', salt='channel')} % "
    f"{len(config.CHANNEL_NAMES)}) + 1 AS INTEGER)]) AS channel_name FROM msg GROUP BY 1) "
    "SELECT conversation_id, channel_name, substr(sha256('channel|' || channel_name), 1, 16) AS channel_id FROM c")
ORACLE["user_messages"] = (
    f"WITH {MSG}, {NB}, p AS (SELECT DISTINCT message_id, conversation_id, u AS user_id FROM nb, "
    "unnest(list_filter([sender, prev_sender], lambda x: x IS NOT NULL)) t(u)) "
    "SELECT user_id, count(*) AS num_messages, count(DISTINCT conversation_id) AS num_conversations FROM p GROUP BY 1")
ORACLE["participants_minus_sender"] = (
    f"WITH {MSG}, {NB}, o AS (SELECT conversation_id, turn, list_filter("
    f"{nonnull_sql('prev_sender', 'sender', 'next_sender')}, lambda x: NOT coalesce(x = sender, false)) AS l FROM nb) "
    "SELECT conversation_id, turn, array_to_string(l, ',') AS participants, CAST(len(l) AS BIGINT) AS n_participants FROM o")
ORACLE["recipients_merge"] = (
    f"WITH {MSG}, {NB}, o0 AS (SELECT conversation_id, turn, list_concat({nonnull_sql('prev_sender')}, "
    f"list_filter({nonnull_sql('next_sender', 'sender')}, lambda x: NOT coalesce(contains(sender, x), false))) AS l0 "
    f"FROM nb), o AS (SELECT conversation_id, turn, {distinct_sql('l0')} AS l FROM o0) SELECT conversation_id, turn, array_to_string(l, ',') AS recipients, CAST(len(l) AS BIGINT) AS n_recipients FROM o")
ORACLE["mention_suffix"] = (
    f"WITH {MSG}, {NB} SELECT conversation_id, turn, body || coalesce(array_to_string(list_transform("
    f"CASE WHEN {hash_int_sql('message_id', salt='mention')} % 2 = 1 THEN {nonnull_sql('prev_sender', 'next_sender')} "
    "ELSE [] END, lambda x: '@' || x || ' '), ''), '') AS comment FROM nb")


# ---------------------------------------------------------------- text
def _q(s):
    return "'" + s.replace("'", "''") + "'"


STOPS_SQL = "[" + ", ".join(_q(s) for s in config.STOPWORDS) + "]"
WS = r"[ \t\n\x0B\f\r]"
TP = (r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]+|https?://[^ \t\n\x0B\f\r]+"
      r"|[\p{L}\p{N}_]+|[^ \t\n\x0B\f\r\p{L}\p{N}_]")
TWP = r"([ \t\n\x0B\f\r]*)(" + TP + ")"
MP = config.MAIL_PATTERN_WIDE
TEXTS = ("tx AS (SELECT 'doc' AS source, doc_id AS id, text FROM documents UNION ALL "
         "SELECT 'page' AS source, page_id AS id, html AS text FROM pages)")
MAILS = (f"mx AS (SELECT DISTINCT source, id, value, 'EMAIL' AS category FROM (SELECT source, id, "
         f"unnest(regexp_extract_all(text, '{MP}', 0)) AS value FROM tx))")


def split_sql(x):
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


ORACLE["clean_text"] = (
    f"SELECT doc_id, regexp_replace(array_to_string(list_filter({split_sql(chr(116) + 'ranslate(lower(text), ' + _q('<>') + ', ' + _q('  ') + ')')}, "
    f"lambda w: NOT list_contains({STOPS_SQL}, lower(w))), ' '), 'http[^ ]+', '', 'g') AS clean FROM documents")
ORACLE["html_strip_brackets"] = "SELECT page_id, translate(html, '<>', '  ') AS text FROM pages"
ORACLE["extract_mails"] = f"WITH {TEXTS}, {MAILS} SELECT * FROM mx"
ORACLE["known_mails"] = (f"WITH {TEXTS}, {MAILS} SELECT id AS doc_id, value FROM mx WHERE source = 'doc' AND "
                         "value IN (SELECT value FROM mx WHERE source = 'page')")
ORACLE["name_tokens"] = (
    f"WITH {TEXTS}, {MAILS}, v AS (SELECT DISTINCT value FROM mx), "
    f"t AS (SELECT value, {split_sql(chr(114) + 'eplace(split_part(value, ' + _q('@') + ', 1), ' + _q('.') + ', ' + _q(' ') + ')')} AS l FROM v) "
    "SELECT value, array_to_string(l, ',') AS tokens, CAST(len(l) AS BIGINT) AS n_tokens FROM t")


def expand_phrase(phrase):
    """Expand '{a|b}' alternatives and 'w?' optional words (oracle side)."""
    out = [[]]
    for w in phrase.split():
        opt = w.endswith("?") and len(w) > 1
        core = w[:-1] if opt else w
        alts = core[1:-1].split("|") if core.startswith("{") and core.endswith("}") else [core]
        if opt:
            alts = alts + [""]
        out = [a + ([x] if x else []) for a in out for x in alts]
    seen, res = set(), []
    for o in out:
        k = " ".join(o)
        if k and k not in seen:
            seen.add(k)
            res.append(k)
    return res


def gazetteer_sql(rows):
    vals = []
    for cat, phrase, canon, cs, ver, pri in rows:
        for p in expand_phrase(phrase):
            c = canon if canon is not None else phrase.lower()
            vals.append(f"({_q(cat)}, {_q(p)}, {_q(c)}, {str(bool(cs)).upper()}, {str(bool(ver)).upper()}, {pri})")
    return ("gz(category, phrase, canonical, case_sensitive, versioned, priority) AS (VALUES " + ", ".join(vals) + "), "
            f"gk AS (SELECT *, array_to_string(regexp_extract_all(phrase, '{TP}', 0), ' ') AS exact, "
            f"len(regexp_extract_all(phrase, '{TP}', 0)) AS n FROM gz), "
            "keys AS (SELECT DISTINCT 'x' AS kind, lower(exact) AS key, exact, n, category, canonical, case_sensitive, "
            "priority FROM gk WHERE n > 0 UNION SELECT DISTINCT 'v', lower(exact), exact, n, category, canonical, FALSE, "
            "priority FROM gk WHERE versioned AND n = 1)")


def matches_sql(rows, max_n=3, docs="documents"):
    grams = ", ".join(f"({i})" for i in range(1, max_n + 1))
    return (
        f"{gazetteer_sql(rows)}, "
        f"d AS (SELECT doc_id, regexp_extract_all(text, '{TWP}', 2) AS t, regexp_extract_all(text, '{TWP}', 1) AS w "
        f"FROM {docs}), "
        "p AS (SELECT doc_id, t, w, unnest(generate_series(1, len(t))) AS i FROM d WHERE len(t) > 0), "
        "g AS (SELECT doc_id, i AS start, n, array_to_string(t[i:i+n-1], ' ') AS exact, "
        "array_to_string(list_transform(generate_series(i, i+n-1), lambda j: CASE WHEN j > i THEN w[j] ELSE '' END || t[j]), '') AS value, "
        "CASE WHEN n = 1 THEN nullif(regexp_extract(lower(t[i]), '^(.*[^0-9])[0-9]+$', 1), '') "
        "WHEN n = 2 AND regexp_matches(t[i+1], '^[0-9]+$') THEN lower(t[i]) END AS vkey "
        f"FROM p, (VALUES {grams}) nn(n) WHERE i + n - 1 <= len(t)), "
        "probe AS (SELECT doc_id, start, n, exact, value, 'x' AS kind, lower(exact) AS key FROM g "
        "UNION ALL SELECT doc_id, start, n, exact, value, 'v', vkey FROM g WHERE vkey IS NOT NULL), "
        "mt AS (SELECT DISTINCT probe.doc_id, probe.start, probe.n AS n_tokens, keys.category, keys.canonical, "
        "keys.priority, probe.value FROM probe JOIN keys ON probe.kind = keys.kind AND probe.key = keys.key "
        "WHERE NOT keys.case_sensitive OR probe.exact = keys.exact)")


def _gaz_rows():
    from kenning.plans.standins import STANDIN_GAZETTEER
    return STANDIN_GAZETTEER


ORACLE["gazetteer_matches"] = f"WITH {matches_sql(_gaz_rows())} SELECT * FROM mt"

# islands of equal words by window functions; rules as (words in order, which may repeat)
ORACLE["gazetteer_repeats"] = (
    "WITH d AS (SELECT p_partkey AS doc_id, string_split('the ' || repeat(CASE WHEN p_partkey % 5 = 0 THEN 'PART ' ELSE 'part ' END, "
    "p_partkey % 20 + 1) || CASE WHEN p_partkey % 3 = 0 THEN 'was ' ELSE 'is ' END || p_type || ' ' || repeat('Steel ', p_partkey % 4) "
    "|| 'and part', ' ') AS ws FROM part), "
    "w AS (SELECT doc_id, ws, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d), "
    "e AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (SELECT *, CASE WHEN lower(word) = lower(lag(word) OVER "
    "(PARTITION BY doc_id ORDER BY i)) THEN 0 ELSE 1 END AS new FROM w)), "
    "s AS (SELECT doc_id, ws, g, lower(any_value(word)) AS word, bool_and(word = 'PART') AS upper_case, min(i) AS start, count(*) AS run "
    "FROM e GROUP BY doc_id, ws, g), "
    "p AS (SELECT *, lead(word) OVER (PARTITION BY doc_id ORDER BY g) AS after FROM s), "
    "m AS (SELECT doc_id, ws, start, run AS n, 'SIZE' AS category, 'part' AS canonical, 1 AS priority FROM p WHERE word = 'part' "
    "UNION ALL SELECT doc_id, ws, start, run + 1, 'SIZE', 'part is', 2 FROM p WHERE word = 'part' AND after IN ('is', 'was') "
    "UNION ALL SELECT doc_id, ws, start, run + 1, 'TYPE', '{steel|brass}+ and', 3 FROM p WHERE word IN ('steel', 'brass') AND after = 'and' "
    "UNION ALL SELECT doc_id, ws, start, run + 1, 'EXACT', '{part}+ is', 4 FROM p WHERE word = 'part' AND upper_case AND after = 'is' "
    "UNION ALL SELECT doc_id, ws, start, run + 1, 'TWO', 'two parts', 5 FROM p WHERE word = 'part' AND run >= 2 AND after = 'is') "
    "SELECT doc_id, start, n::INTEGER AS n_tokens, category, canonical, priority, array_to_string(ws[start:start + n - 1], ' ') AS value FROM m")

# spans in order of choice, folded left to right: one is kept if it overlaps none kept so far
SPANS = (
    "s AS (SELECT doc_id, list([{start: start, n_tokens: n_tokens, category: category, priority: priority, "
    "canonical: canonical, value: value}] ORDER BY n_tokens DESC, start, priority, category, canonical, value) AS spans "
    "FROM mt GROUP BY doc_id), "
    "chosen AS (SELECT doc_id, unnest(list_reduce(spans, lambda kept, x: CASE WHEN len(list_filter(kept, lambda a: "
    "a.start < x[1].start + x[1].n_tokens AND x[1].start < a.start + a.n_tokens)) > 0 THEN kept ELSE kept || x END)) AS k FROM s)")
ORACLE["longest_spans"] = (
    f"WITH {matches_sql(_gaz_rows())}, {SPANS} "
    "SELECT doc_id, k.start, k.n_tokens, k.category, k.priority, k.canonical, k.value FROM chosen")

ORACLE["self_mention_filter"] = (
    "WITH r AS (SELECT doc_id, regexp_extract_all(lower(text), '\\p{L}+', 0) AS words, "
    f"unnest(list_filter(regexp_extract_all(text, '{MP}', 0), lambda x, i: list_position(regexp_extract_all(text, '{MP}', 0), x) = i)) AS mail FROM documents), "
    f"o AS (SELECT *, list_transform({split_sql(chr(114) + 'eplace(split_part(mail, ' + _q('@') + ', 1), ' + _q('.') + ', ' + _q(' ') + ')')}, "
    "lambda t: rtrim(lower(t))) AS own FROM r) "
    "SELECT doc_id, mail, CAST(len(words) AS BIGINT) AS n_words, "
    "CAST(len(list_filter(words, lambda x: NOT len(list_filter(own, lambda y: starts_with(x, y))) > 0)) AS BIGINT) AS n_kept FROM o")

ORACLE["title_case"] = ("SELECT p_partkey, " + TITLE.format(x="p_name || '-' || p_brand || ' ' || p_type")
                        + " AS title FROM part")


# ---------------------------------------------------------------- directory, names and addresses
def words_sql(x):
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


ORACLE["name_completion"] = (
    "WITH pool AS (SELECT DISTINCT p_brand, p_name AS value FROM part UNION SELECT DISTINCT p_brand, "
    "split_part(p_name, ' ', 1) FROM part), "
    "m AS (SELECT DISTINCT a.p_brand, a.value, b.value AS y FROM pool a JOIN pool b ON a.p_brand = b.p_brand AND "
    f"(starts_with(b.value, a.value) OR (len({words_sql('a.value')}) = 1 AND ends_with(b.value, a.value)))), "
    "mx AS (SELECT p_brand, value, max(length(y)) AS l FROM m GROUP BY ALL) "
    "SELECT m.p_brand, m.value, array_to_string(list_sort(list_distinct(list(y))), ' ') AS completed "
    "FROM m JOIN mx USING (p_brand, value) WHERE length(y) = mx.l GROUP BY m.p_brand, m.value")


def _aliases_sql():
    from kenning.plans.standins import STANDIN_ALIASES
    return ", ".join(f"({_q(a)}, {_q(c)}, {o})" for a, c, o in STANDIN_ALIASES)


ORACLE["alias_map"] = (
    f"WITH a(alias, canonical, ord) AS (VALUES {_aliases_sql()}), "
    "d AS (SELECT alias, arg_max(canonical, ord) AS canonical FROM a GROUP BY 1) "
    "SELECT p_partkey, p_name, coalesce(d.canonical, p_name) AS value FROM part LEFT JOIN d ON part.p_name = d.alias")

NAMES = (
    "names AS (SELECT DISTINCT value FROM (SELECT p_name AS value FROM part UNION ALL SELECT split_part(p_name, ' ', 1) "
    "FROM part UNION ALL SELECT split_part(p_name, ' ', 2) FROM part UNION ALL SELECT lower(c_mktsegment) FROM customer) "
    "WHERE value IS NOT NULL), "
    "dir AS (SELECT 'SUB' || CAST(p_partkey AS VARCHAR) AS sub_id, p_type || ' ' || p_brand AS user_name, p_partkey AS ord "
    "FROM part), "
    "known AS (SELECT DISTINCT replace(p_name, ' ', '.') || '@' || lower(replace(p_brand, '#', '')) || '.example.com' "
    "AS address FROM part)")
# names(value), dir(sub_id, user_name, ord), known(address) -> res(value, name_id, name_display)
RESOLVED = (
    f"kp AS (SELECT address, list_distinct(list_transform({words_sql(chr(114) + 'eplace(split_part(address, ' + _q('@') + ', 1), ' + _q('.') + ', ' + _q(' ') + ')')}, lambda t: lower(t))) AS parts FROM known), "
    f"n0 AS (SELECT value, replace(split_part(value, '@', 1), '.', ' ') AS plain FROM names), "
    f"n AS (SELECT value, plain, lower({words_sql('plain')}[1]) AS w1, lower({words_sql('plain')}[2]) AS w2 FROM n0), "
    "t1 AS (SELECT n.value, min(dir.ord) AS ord FROM n JOIN dir ON contains(lower(dir.user_name), n.w1) AND "
    "(n.w2 IS NULL OR contains(lower(dir.user_name), n.w2)) GROUP BY 1), "
    "t1n AS (SELECT t1.value, dir.sub_id, dir.user_name FROM t1 JOIN dir USING (ord)), "
    "t2 AS (SELECT n.value, min(kp.address) AS address FROM n JOIN kp ON list_contains(kp.parts, n.w1) AND "
    "(n.w2 IS NULL OR list_contains(kp.parts, n.w2)) GROUP BY 1), "
    "res AS (SELECT n.value, coalesce(t1n.sub_id, t2.address, n.plain) AS name_id, "
    f"CASE WHEN t1n.sub_id IS NOT NULL THEN {TITLE.format(x='t1n.user_name')} "
    f"WHEN t2.address IS NOT NULL THEN {TITLE.format(x='array_to_string(' + words_sql(chr(114) + 'eplace(split_part(t2.address, ' + _q('@') + ', 1), ' + _q('.') + ', ' + _q(' ') + ')') + ', ' + _q(' ') + ')')} END AS name_display "
    "FROM n LEFT JOIN t1n USING (value) LEFT JOIN t2 USING (value))")
ORACLE["name_to_id"] = f"WITH {NAMES}, {RESOLVED} SELECT value, name_id FROM res"
ORACLE["name_to_display"] = f"WITH {NAMES}, {RESOLVED} SELECT value, name_display FROM res"

MAILRES = (
    f"{TEXTS}, {MAILS}, mails AS (SELECT DISTINCT value FROM mx), "
    f"dir0 AS (SELECT unnest({distinct_sql(chr(114) + 'egexp_extract_all(html, ' + _q(MP) + ', 0)')}) AS email_id, "
    "'PAGE' || CAST(page_id AS VARCHAR) AS sub_id, regexp_extract(url, '://([^/:?#]+)', 1) AS user_name, page_id AS ord "
    "FROM pages), "
    "dir AS (SELECT email_id, arg_min(sub_id, ord) AS sub_id, arg_min(user_name, ord) AS user_name FROM dir0 GROUP BY 1), "
    "known AS (SELECT DISTINCT value AS address FROM mx WHERE source = 'doc'), "
    "res AS (SELECT m.value, CASE WHEN length(m.value) > 3 AND d.sub_id IS NOT NULL THEN d.sub_id ELSE m.value END AS mail_id, "
    f"CASE WHEN length(m.value) > 3 AND d.sub_id IS NOT NULL THEN {TITLE.format(x='d.user_name')} "
    f"WHEN k.address IS NOT NULL THEN {TITLE.format(x='array_to_string(' + words_sql(chr(114) + 'eplace(split_part(m.value, ' + _q('@') + ', 1), ' + _q('.') + ', ' + _q(' ') + ')') + ', ' + _q(' ') + ')')} END AS mail_display "
    "FROM mails m LEFT JOIN dir d ON d.email_id = m.value LEFT JOIN known k ON k.address = m.value)")
ORACLE["mail_to_id"] = f"WITH {MAILRES} SELECT value, mail_id FROM res"
ORACLE["mail_to_name"] = f"WITH {MAILRES} SELECT value, mail_display FROM res"

ORACLE["directory_left_join"] = (
    f"WITH {MENTIONS}, {COUNTS}, d AS (SELECT CAST(c_custkey AS VARCHAR) AS email_id, 'C' || CAST(c_custkey AS VARCHAR) "
    "AS sub_id, c_name AS user_name FROM customer) "
    "SELECT c.email_id, c.category, c.value, c.frequency, "
    "'USER_' || coalesce(d.sub_id, c.email_id) AS sub_id, "
    f"{TITLE.format(x='d.user_name')} AS userName, "
    f"CASE WHEN d.sub_id IS NULL THEN '{config.ID_TYPE_EMAIL}' ELSE '{config.ID_TYPE_DIRECTORY}' END AS id_type "
    "FROM (SELECT *, CASE WHEN category = 'error' THEN 'guest.' || user_id ELSE user_id END AS email_id FROM c) c "
    "LEFT JOIN d ON d.email_id = c.email_id")

ORDER_ENTRIES = (
    "dir AS (SELECT 'customer.' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '@example.com' AS email, "
    "'USER_' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS display FROM customer), "
    "p0 AS (SELECT o_orderkey, ['customer.' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '@example.com', "
    "'customer.' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '@example.com', "
    "'status.' || lower(o_orderstatus) || '@example.com'] AS l0 FROM orders), "
    f"p AS (SELECT o_orderkey, {distinct_sql('l0')} AS l FROM p0), "
    "e AS (SELECT o_orderkey, unnest(l) AS email, unnest(generate_series(1, len(l))) AS pos FROM p), "
    "j AS (SELECT e.*, dir.user_id, dir.display FROM e LEFT JOIN dir USING (email))")
ORACLE["permissions_expand"] = (
    f"WITH {ORDER_ENTRIES} SELECT o_orderkey, string_agg(CASE WHEN user_id IS NULL THEN email ELSE email || ',' || user_id "
    "END, ',' ORDER BY pos) AS permissions FROM j GROUP BY 1")
ORACLE["user_structs"] = (
    f"WITH {ORDER_ENTRIES} SELECT o_orderkey, string_agg(coalesce(user_id, '') || '|' || coalesce(display, '') || '|' || "
    "email, ';' ORDER BY pos) AS users, CAST(count(*) FILTER (WHERE user_id IS NULL) AS BIGINT) AS n_unknown FROM j GROUP BY 1")



# ---------------------------------------------------------------- the message pipelines on orders
def _address_sql(k):
    return f"'customer.' || lpad(CAST({k} AS VARCHAR), 9, '0') || '@example.com'"


# lists already parsed: a malformed cell is a null list
MESSAGE_ROWS = (
    "dir AS (SELECT " + _address_sql("c_custkey") + " AS email, 'USER_' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS display FROM customer), "
    "o AS (SELECT *, o_orderkey AS k, " + _address_sql("o_custkey") + " AS own, " + _address_sql("o_orderkey") + " AS other, "
    "'status.' || lower(o_orderstatus) || '@example.com' AS status FROM orders), "
    "msg AS (SELECT k AS seq, o_custkey AS conv, o_orderpriority AS subject, 'order ' || CAST(k AS VARCHAR) AS body, own, other, "
    "CASE WHEN k % 13 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS received, "
    "CASE WHEN k % 17 <> 0 THEN CAST(DATE '2001-01-01' + CAST(k % 700 AS INTEGER) AS TIMESTAMP) END AS said, "
    "CASE WHEN k % 19 <> 0 THEN o_orderpriority ELSE 'nan' END AS component, "
    "CASE WHEN o_orderstatus = 'F' THEN []::VARCHAR[] ELSE [status] END AS l_to, "
    "CASE WHEN o_orderstatus = 'F' THEN []::VARCHAR[] ELSE [own, other] END AS l_cc, "
    "'paid ' || CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) AS comment, "
    "CASE WHEN k % 97 = 0 THEN NULL WHEN o_orderstatus = 'F' AND k % 2 = 0 THEN []::VARCHAR[] ELSE [own, own, other, status] END AS perms FROM o)")
_OUT_TS = "'%Y-%m-%dT%H:%M:%SZ'"
_SHIFTED = (f"strftime(CASE WHEN received IS NULL OR said IS NULL THEN said ELSE said + to_days(CAST(floor((epoch_us(received) - "
            f"epoch_us(said)) / 86400000000.0) AS INTEGER) + 1) END, {_OUT_TS})")


def looked_up_sql(src, key, cols):
    """CTEs t_<col>: a list column of ``src`` looked up in ``dir``, as text with ids and as users."""
    out = []
    for c in cols:
        out.append(
            f"t_{c} AS (SELECT e.{key}, string_agg(e.email || coalesce(',' || dir.user_id, ''), ',' ORDER BY pos) AS ids, "
            "string_agg(coalesce(dir.user_id, '') || '|' || coalesce(dir.display, '') || '|' || e.email, ';' ORDER BY pos) AS users, "
            f"list(dir.display ORDER BY pos) AS names FROM (SELECT {key}, unnest({c}) AS email, "
            f"unnest(generate_series(1, len({c}))) AS pos FROM {src}) e LEFT JOIN dir USING (email) GROUP BY 1)")
    return ", ".join(out)


def _text_or_empty(l, t):
    return f"CASE WHEN {l} IS NOT NULL THEN coalesce({t}, '') END"


ORACLE["mail_conversations"] = (
    f"WITH {MESSAGE_ROWS}, f AS (SELECT *, count(*) OVER (PARTITION BY conv) AS n, {distinct_sql('perms')} AS p, [own] AS frm, "
    "list_concat(l_to, list_filter(l_cc, lambda x: NOT contains(own, x))) AS rec FROM msg WHERE received IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY conv ORDER BY seq) = 1), "
    f"{looked_up_sql('f', 'seq', ['p', 'rec', 'frm'])} "
    "SELECT CAST(conv AS VARCHAR) AS conversation_id, CASE subject WHEN '5-LOW' THEN '5-NONE' ELSE subject END AS subject, body, "
    f"strftime(received, {_OUT_TS}) AS date, CAST(conv AS VARCHAR) AS id, {_text_or_empty('p', 't_p.ids')} AS permissions, "
    f"{_text_or_empty('rec', 't_rec.users')} AS recipients, 'email-message' AS type, t_frm.users AS sender, n AS num_messages "
    "FROM f LEFT JOIN t_p USING (seq) LEFT JOIN t_rec USING (seq) LEFT JOIN t_frm USING (seq)")

ORACLE["chat_messages"] = (
    f"WITH {MESSAGE_ROWS}, f AS (SELECT *, {_SHIFTED} AS date, [other] AS frm, list_filter(perms, lambda x: x <> other) AS rec "
    "FROM msg WHERE perms IS NOT NULL AND said IS NOT NULL), "
    f"{looked_up_sql('f', 'seq', ['perms', 'rec', 'frm'])} "
    "SELECT CAST(conv AS VARCHAR) AS conversation_id, CAST(seq AS VARCHAR) AS message_id, subject, comment AS body, date, "
    "CAST(seq AS VARCHAR) AS id, coalesce(t_perms.ids, '') AS permissions, coalesce(t_rec.users, '') AS recipients, 'email' AS type, "
    "t_frm.users AS sender FROM f LEFT JOIN t_perms USING (seq) LEFT JOIN t_rec USING (seq) LEFT JOIN t_frm USING (seq)")


def _team_sql():
    teams = "[" + ", ".join(_q(t) for t in config.TEAM_NAMES) + "]"
    n_ch = len(config.CHANNEL_NAMES)
    coin, many, which = (hash_int_sql("seq", salt="mention-coin"), hash_int_sql("seq", salt="mention-k"),
                         hash_int_sql("seq", "i", salt="mention"))
    tail = "coalesce(team_id, '-') || '|' || coalesce(team_name, '-') || '|' || channel_id || '|' || channel_name || '|' || "
    return (
        f"WITH {MESSAGE_ROWS}, tm AS (SELECT component, {teams}[CAST(dense_rank() OVER (ORDER BY component) AS INTEGER)] AS team_name "
        "FROM (SELECT DISTINCT component FROM msg)), "
        f"f AS (SELECT *, substr(sha256('team|' || team_name), 1, 36) AS team_id, {_CH}[CAST(({hash_int_sql('conv', 'seq', salt='channel')} % {n_ch}) + 1 "
        "AS INTEGER)] AS ch FROM msg JOIN tm USING (component)), "
        f"{looked_up_sql('f', 'seq', ['perms'])}, "
        "g0 AS (SELECT f.*, t_perms.ids, coalesce(t_perms.names, []) AS names, max(ch) OVER (PARTITION BY conv) AS channel_name, "
        "row_number() OVER (PARTITION BY conv ORDER BY seq) AS place FROM f LEFT JOIN t_perms USING (seq)), "
        f"pick AS (SELECT seq, i, names[CAST({which} % len(names) + 1 AS INTEGER)] AS name FROM (SELECT seq, names, "
        "unnest(generate_series(1, CAST("
        f"{many} % greatest(len(list_distinct(names)) + CAST(len(list_filter(names, lambda x: x IS NULL)) > 0 AS INTEGER), 1) + 1 AS BIGINT))) AS i "
        f"FROM g0 WHERE len(names) > 0 AND {coin} % 2 = 1)), "
        "mention AS (SELECT seq, string_agg(name, ',' ORDER BY i) AS listed, string_agg('@' || name || ' ', '' ORDER BY i) AS said_to "
        "FROM pick GROUP BY 1), "
        "g AS (SELECT g0.*, coalesce(listed, '') AS listed, comment || coalesce(said_to, '') AS text, "
        "substr(sha256('channel|' || channel_name), 1, 45) AS channel_id, who.user_id AS by_id, who.display AS by_name, "
        "snd.user_id AS snd_id, snd.display AS snd_name FROM g0 LEFT JOIN mention USING (seq) LEFT JOIN dir who ON who.email = g0.other "
        "LEFT JOIN dir snd ON snd.email = g0.own), "
        "r AS (SELECT conv, count(*) AS n, string_agg(CAST(seq AS VARCHAR) || '|' || " + tail +
        "text || '|' || coalesce(by_id, '-') || '|' || coalesce(by_name, '-') || '|' || "
        f"coalesce({_SHIFTED}, '-') || '|' || listed || '|REPLY', ';' ORDER BY seq) AS replies FROM g WHERE place > 1 GROUP BY 1) "
        f"SELECT CAST(conv AS VARCHAR) AS conversation_id, CAST(conv AS VARCHAR) AS id, strftime(received, {_OUT_TS}) AS date, "
        f"{_text_or_empty('perms', 'ids')} AS permissions, CAST(conv AS VARCHAR) || '|' || " + tail +
        "body || '|' || coalesce(snd_id, '-') || '|' || coalesce(snd_name, '-') || '|' || "
        f"coalesce(strftime(received, {_OUT_TS}), '-') || '|MESSAGE' AS message, coalesce(r.replies, '') AS replies, "
        "CAST(coalesce(r.n, 0) AS BIGINT) AS n_replies FROM g LEFT JOIN r USING (conv) WHERE place = 1")


ORACLE["team_conversations"] = _team_sql()

# ---------------------------------------------------------------- dates, nulls, counts, dictionaries, pseudonyms
# forms written from the date itself, so what they must read as is known
_DATE_FORMS_SQL = " ".join(
    f"SELECT '{name}' AS source, o_orderkey AS k1, 0 AS k2, strftime(o_orderdate, '{form}') AS raw, "
    f"strftime(date_trunc('{unit}', o_orderdate), '%Y-%m-%dT%H:%M:%SZ') AS clean FROM orders UNION ALL"
    for name, form, unit in (("space_offset", "%Y-%m-%d %H:%M:%S+00:00", "second"), ("slashes", "%-m/%-d/%Y", "day"),
                             ("half_day", "%-m/%-d/%Y %-I:%M %p", "minute"), ("day_first", "%-d %B %Y %H:%M", "minute"),
                             ("no_comma", "%b %-d %Y", "day"), ("to_the_minute", "%Y-%m-%dT%H:%M", "minute"),
                             ("dashes", "%d-%b-%Y", "day"), ("digits", "%Y%m%d", "day"), ("c_time", "%a %b %d %H:%M:%S %Y", "second"),
                             ("comment", "%a, %-d %b %Y %H:%M:%S +0000 (UTC)", "second"), ("dots", "%Y.%m.%d", "day"),
                             ("header", "%a, %d %b %Y %H:%M:%S +0000", "second"), ("long", "%-d %B %Y", "day"),
                             ("american", "%B %-d, %Y", "day"), ("minutes", "%Y-%m-%d %H:%M", "minute"),
                             ("offset", "%Y-%m-%dT%H:%M:%S+0000", "second"))) + " "
ORACLE["date_clean"] = (
    "WITH raw AS (SELECT 'orders' AS source, o_orderkey AS k1, 0 AS k2, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS raw "
    "FROM orders UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber, strftime(l_shipdate, '%d %b %Y') FROM lineitem "
    "UNION ALL SELECT 'priority', o_orderkey, 0, o_orderpriority FROM orders) "
    + _DATE_FORMS_SQL +
    "SELECT 'zone', o_orderkey, 0, strftime(o_orderdate, '%-d %b %Y %H:%M:%S EST'), "
    "strftime(date_trunc('second', o_orderdate) + INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%SZ') FROM orders UNION ALL "
    "SELECT 'left_over', o_orderkey, 0, strftime(o_orderdate, '%Y-%m-%d or so'), NULL FROM orders UNION ALL "
    "SELECT source, k1, k2, raw, strftime(try_strptime(raw, ['%Y-%m-%d %H:%M:%S', '%d %b %Y']), '%Y-%m-%dT%H:%M:%SZ') "
    "AS clean FROM raw")
# the cells are written from these values, so what they must read as is known
ORACLE["list_literals"] = (
    "WITH o AS (SELECT o_orderkey, o_orderpriority AS a, 'it''s ' || o_orderstatus AS b FROM orders) "
    "SELECT o_orderkey, unnest(['double', 'escaped', 'none', 'comma', 'tuple', 'empty', 'numbers', 'junk', 'open', 'names', 'lone', 'blank', "
    "'null']) AS form, unnest([a || '|' || b, a || '|' || b, '-|' || a, a, a || '|A' || chr(9), '', '1|-2.5', NULL, NULL, NULL, NULL, NULL, "
    "NULL]) AS items FROM o")
ORACLE["malformed_literals"] = (
    "SELECT 0::BIGINT AS malformed_double, 0::BIGINT AS malformed_tuple, count(*) AS malformed_junk, count(*) AS malformed_open, "
    "count(*) AS malformed_names, count(*) AS malformed_lone, count(*) AS malformed_blank, 0::BIGINT AS malformed_null FROM orders")
ORACLE["date_shift"] = (
    "WITH f AS (SELECT user_id, min(ts) AS received FROM events GROUP BY 1) "
    "SELECT e.event_id, strftime(e.ts + to_days(CAST(floor((epoch_us(f.received) - epoch_us(e.ts)) / 86400000000.0) "
    "AS INTEGER) + 1), '%Y-%m-%dT%H:%M:%SZ') AS shifted FROM events e JOIN f USING (user_id)")
ORACLE["iso_valid"] = (
    "WITH raw AS (SELECT o_orderkey, 'plain' AS form, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS raw FROM orders "
    "UNION ALL SELECT o_orderkey, 'zulu', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') FROM orders "
    "UNION ALL SELECT o_orderkey, 'broken', strftime(o_orderdate, '%Y-%m-%dT:%H:%M:%S') FROM orders) "
    f"SELECT *, coalesce(regexp_matches(raw, {_q(config.ISO8601_PATTERN)}), false) AS valid FROM raw")
DL = "dl AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"
ORACLE["null_profile"] = (
    f"WITH {DL} SELECT count(*) AS n_rows, count(*) FILTER (WHERE quality IS NULL) AS null_quality, "
    "count(*) FILTER (WHERE toxic IS NULL) AS null_toxic, count(*) FILTER (WHERE lang IS NULL) AS null_lang, "
    "count(*) FILTER (WHERE source IS NULL) AS null_source FROM dl")
ORACLE["fill_from_column"] = (
    f"WITH {DL} SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, quality, 0) AS toxic FROM dl")
ORACLE["value_counts"] = (
    "SELECT lang AS value, count(*) AS n, 'lang' AS \"column\" FROM documents GROUP BY 1 UNION ALL "
    "SELECT o_orderpriority, count(*), 'o_orderpriority' FROM orders GROUP BY 1")
ORACLE["distinct_values"] = (
    "SELECT count(DISTINCT lang) AS n_distinct, 'lang' AS \"column\" FROM documents UNION ALL "
    "SELECT count(DISTINCT source), 'source' FROM documents UNION ALL SELECT count(DISTINCT o_custkey), 'o_custkey' FROM orders")
ORACLE["minmax_scale"] = (
    "WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) "
    f"SELECT o_orderkey, round({_mm('o_totalprice', 'lo', 'hi')}, 6) AS scaled01, "
    f"round({_mm('o_totalprice', 'lo', 'hi', 0.1)}, 6) AS scaled0110 FROM orders, s")
ORACLE["dict_overlay"] = (
    "WITH o AS (SELECT c_nationkey AS nationkey, arg_max(c_name, c_custkey) AS name FROM customer GROUP BY 1), "
    "n AS (SELECT s_nationkey AS nationkey, arg_max(s_name, s_suppkey) AS name FROM supplier GROUP BY 1) "
    "SELECT coalesce(o.nationkey, n.nationkey) AS nationkey, coalesce(n.name, o.name) AS name, "
    "CASE WHEN n.name IS NOT NULL THEN 'new' ELSE 'old' END AS origin FROM o FULL OUTER JOIN n USING (nationkey)")
_TEAMS = "[" + ", ".join(_q(t) for t in config.TEAM_NAMES) + "]"
ORACLE["pseudo_ids"] = (
    f"WITH seg AS (SELECT c_mktsegment, {_TEAMS}[CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS INTEGER)] AS team_name "
    "FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL)) "
    "SELECT c_custkey, CAST(c_custkey AS VARCHAR) || substr(sha256('id|' || CAST(c_custkey AS VARCHAR)), 1, 8) AS pseudo_id, "
    "c_mktsegment, team_name, substr(sha256('team|' || team_name), 1, 12) AS team_id FROM customer LEFT JOIN seg USING (c_mktsegment)")

# ---------------------------------------------------------------- readers, writers and functions of the jobs
_CONV = ("CAST(conv_id AS VARCHAR) AS conversation_id, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS message_id")
ORACLE["conversation_files_a"] = (
    f"SELECT {_CONV}, CASE WHEN turn > 0 THEN role ELSE 'NA' END AS subject, text AS body, role || '@chat.example' AS from_email, "
    "'all@chat.example,' || role || '@chat.example' AS \"to\", 0 AS n_cc FROM conversations")
ORACLE["conversation_files_b"] = (
    f"SELECT {_CONV}, 's' AS subject, text AS body, lower(role) || '@chat.example' AS from_email, "
    "'all@chat.example,' || lower(role) || '@chat.example' AS \"to\", 0 AS n_cc FROM conversations")
ORACLE["json_dictionaries"] = "SELECT form, c_name AS key, c_mktsegment AS value FROM customer, (VALUES ('object'), ('lines')) f(form)"
ORACLE["profile_files"] = f"WITH {MENTIONS}, {COUNTS} SELECT * FROM c WHERE value IS NOT NULL"
ORACLE["state_versions"] = f"WITH {MENTIONS}, {COUNTS} SELECT * FROM c"
ORACLE["json_and_csv_files"] = (
    "SELECT form, o_orderkey, o_orderpriority, o_orderstatus || '|it''s, \"so\"' AS tags FROM orders, (VALUES ('json'), ('csv')) f(form)")
ORACLE["pieces"] = (
    "SELECT count(*) AS n, min(c_custkey) AS first, max(c_custkey) AS last FROM "
    "(SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 700 AS piece FROM customer) GROUP BY piece")
ORACLE["content_text"] = (
    "SELECT p_partkey, concat_ws(' ', CASE WHEN p_partkey % 3 > 0 THEN p_brand END, p_name, p_brand || '   ' || p_type) AS content, "
    "p_brand || ', ' || p_type AS trimmed, p_name || '/' || p_type || ')' AS slashed FROM part")
ORACLE["logistic"] = "SELECT c_custkey, round(1.0 / (1.0 + exp(-c_acctbal / 1000.0)), 6) AS p FROM customer"
ORACLE["profiled_users"] = (
    "WITH e AS (SELECT DISTINCT user_id FROM (SELECT source || '@docs.example' AS user_id FROM documents UNION ALL "
    f"SELECT unnest(regexp_extract_all(text, '{MP}', 0)) FROM documents) WHERE user_id IS NOT NULL) "
    "SELECT user_id, (ends_with(user_id, '@docs.example') OR length(user_id) % 3 = 0) AND length(user_id) > 20 AS profiled FROM e")
ORACLE["first_orders"] = "SELECT o_orderkey, o_orderdate, o_custkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100"


# ---------------------------------------------------------------- the whole interest job on documents
def crc32_sql(x):
    """CRC-32 of an ASCII string, byte by byte and bit by bit."""
    bit = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    chars = f"list_transform(string_split({x}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    return (f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {chars}), "
            f"lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {bit})), 4294967295)")


def completed_sql(src, group, out):
    """CTE ``out`` (group, value, done): each name of ``src`` as the longest names of its
    group that start with it, or, if it is one word, end with it."""
    return (f"{out} AS (SELECT {group}, value, string_agg(y, ' ' ORDER BY y) AS done FROM (SELECT DISTINCT a.{group}, a.value, b.value AS y "
            f"FROM {src} a JOIN {src} b ON a.{group} = b.{group} AND (starts_with(b.value, a.value) OR (len({words_sql('a.value')}) = 1 "
            f"AND ends_with(b.value, a.value))) QUALIFY length(b.value) = max(length(b.value)) OVER (PARTITION BY a.{group}, a.value)) GROUP BY ALL)")


def _words_of_address(x):
    return words_sql(f"replace(split_part({x}, '@', 1), '.', ' ')")


_AGED = decay_sql("frequency", "date_diff('day', day, DATE '2001-08-03')", config.DECAY_SCHEDULES["v3"])
_SAID = f"array_to_string({_words_of_address('m.value')}, ' ')"
_MAIL_ROW = "length(m.value) > 3 AND d.sub_id IS NOT NULL"
ORACLE["document_interests"] = (
    # dates and the directory
    "WITH latest AS (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS latest FROM orders GROUP BY 1), "
    f"src AS (SELECT source, {crc32_sql('source')} % 4 AS pick, try_cast(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) + 1 AS o_custkey "
    "FROM (SELECT DISTINCT source FROM documents)), "
    f"texts AS (SELECT doc_id, lang, text, source, source || '@docs.example' AS sender, {distinct_sql(f'regexp_extract_all(text, {_q(MP)}, 0)')} "
    "AS rcpt, pick, latest - CAST(CASE WHEN doc_id % 3 = 0 THEN doc_id % 400 ELSE 0 END AS INTEGER) AS sent "
    "FROM documents LEFT JOIN src USING (source) LEFT JOIN latest ON latest.o_custkey = src.o_custkey AND pick <> 1), "
    "dir AS (SELECT CAST(doc_id AS VARCHAR) AS sub_id, coalesce(rcpt[1], CASE WHEN pick <> 0 THEN sender END) AS email_id, "
    "array_to_string(regexp_extract_all(text, '\\p{L}+', 0)[1:3], ' ') AS user_name, doc_id AS ord FROM texts "
    "WHERE doc_id IN (SELECT c_custkey FROM customer) AND coalesce(rcpt[1], CASE WHEN pick <> 0 THEN sender END) IS NOT NULL), "
    "first_dir AS (SELECT email_id, arg_min(sub_id, ord) AS sub_id, arg_min(user_name, ord) AS user_name FROM dir GROUP BY 1), "
    # messages and their entities
    "msgs AS (SELECT doc_id, sender, rcpt, CASE WHEN doc_id % 13 <> 0 THEN sent END AS day, "
    f"regexp_replace(array_to_string(list_filter({split_sql(f'concat_ws({_q(chr(32))}, lang, text, array_to_string(rcpt, {_q(chr(32))}))')}, "
    f"lambda w: NOT list_contains({STOPS_SQL}, lower(w))), ' '), 'http[^ ]+', '', 'g') AS text FROM texts), "
    f"{matches_sql(_gaz_rows(), docs='msgs')}, {SPANS}, "
    "spans AS (SELECT doc_id, k.category AS category, k.value AS value FROM chosen), "
    "span_names AS (SELECT DISTINCT doc_id, value FROM spans), "
    f"{completed_sql('span_names', 'doc_id', 'span_done')}, "
    "parts AS (SELECT DISTINCT doc_id, u AS user_id, day FROM msgs, "
    "unnest(list_filter(list_concat([sender], coalesce(rcpt, [])), lambda x: x IS NOT NULL)) t(u)), "
    "known AS (SELECT DISTINCT user_id AS address FROM parts), "
    f"written AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, {_q(MP)}, 0)) AS value FROM msgs), "
    "ents AS (SELECT doc_id, coalesce(done, value) AS value, category FROM spans LEFT JOIN span_done USING (doc_id, value) "
    "UNION ALL SELECT doc_id, value, 'EMAIL' FROM written WHERE value IN (SELECT address FROM known)), "
    # mentions of each profiled user, counted and aged
    "users AS (SELECT * FROM parts WHERE (ends_with(user_id, '@docs.example') OR user_id IN (SELECT email_id FROM dir)) AND length(user_id) > 3), "
    f"said AS (SELECT user_id, category, rtrim(lower(value)) AS value, list_transform({_words_of_address('user_id')}, "
    "lambda t: rtrim(lower(t))) AS own FROM users JOIN ents USING (doc_id)), "
    "mentions AS (SELECT user_id, category, value FROM said WHERE len(list_filter(own, lambda y: starts_with(value, y))) = 0), "
    "people AS (SELECT DISTINCT user_id, value FROM mentions WHERE category = 'PEOPLE'), "
    f"{completed_sql('people', 'user_id', 'people_done')}, "
    "counts AS (SELECT user_id, category, CASE WHEN category = 'PEOPLE' THEN coalesce(done, value) ELSE value END AS value, "
    "count(*) AS frequency FROM mentions LEFT JOIN people_done USING (user_id, value) GROUP BY ALL), "
    "days AS (SELECT user_id, day FROM (SELECT user_id, day, count(*) AS n FROM users WHERE day IS NOT NULL GROUP BY ALL) "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, day) = 1), "
    f"aged AS (SELECT counts.*, CASE WHEN day IS NULL THEN frequency ELSE {_AGED} END AS decay_frequency "
    "FROM counts LEFT JOIN days USING (user_id)), "
    "ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id, category ORDER BY frequency DESC, value) AS BIGINT) AS rank FROM aged), "
    "keyed AS (SELECT user_id, category, replace(value, ' (', '/') AS value, frequency, decay_frequency, rank, "
    "replace(printf('TAG_%s_%04d', category, rank), ' (', '/') AS sk FROM ranked), "
    # names and addresses
    f"names AS (SELECT DISTINCT value FROM keyed WHERE category = 'PEOPLE'), {RESOLVED}, "
    f"mres AS (SELECT m.value, CASE WHEN {_MAIL_ROW} THEN d.sub_id ELSE m.value END AS mail_id, CASE WHEN {_MAIL_ROW} "
    f"THEN {TITLE.format(x='d.user_name')} WHEN known.address IS NOT NULL THEN {TITLE.format(x=_SAID)} END AS mail_display "
    "FROM (SELECT DISTINCT value FROM keyed WHERE category = 'EMAIL') m LEFT JOIN first_dir d ON d.email_id = m.value "
    "LEFT JOIN known ON known.address = m.value), "
    "found AS (SELECT 'PEOPLE' AS category, value, name_id AS alt, name_display AS avatar FROM res "
    "UNION ALL SELECT 'EMAIL', value, mail_id, mail_display FROM mres), "
    "rows_ AS (SELECT user_id AS email_id, CASE category WHEN 'COMPONENTS' THEN 'TOPICS' WHEN 'EMAIL' THEN 'PEOPLE' ELSE category END AS category, "
    "value, frequency, decay_frequency, rank, sk, CASE category WHEN 'PEOPLE' THEN 'Mention' WHEN 'EMAIL' THEN 'Mail' END AS entityLabel, "
    f"'USER_' || alt AS nameToId, coalesce(avatar, {TITLE.format(x='value')}) AS entityName, "
    f"'USER_' || coalesce(first_dir.sub_id, user_id) AS sub_id, {TITLE.format(x='first_dir.user_name')} AS userName, "
    f"CASE WHEN first_dir.sub_id IS NULL THEN '{config.ID_TYPE_EMAIL}' ELSE '{config.ID_TYPE_DIRECTORY}' END AS id_type "
    "FROM keyed LEFT JOIN found USING (category, value) LEFT JOIN first_dir ON first_dir.email_id = user_id), "
    + weights_sql("rows_", "PEOPLE", ("TOPICS", "PEOPLE", "TEAMS", "PROG_SCRIPT_LANG"),
                  "email_id, category, value, frequency, decay_frequency, rank, sk, entityLabel, nameToId, entityName, sub_id, userName, id_type"))
