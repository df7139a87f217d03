"""SQL twins of the projections, as common table expressions for DuckDB."""

AA = "ACDEFGHIKLMNPQRSTVWY"

SEQS = """
seqs AS (
  SELECT pid, sequence FROM (
    SELECT doc_id AS pid,
           translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BJOUXZ', '') AS sequence
    FROM documents) WHERE length(sequence) > 0
)"""

RES = """
res AS (
  SELECT pid, length(sequence) AS n, unnest(range(1, length(sequence) + 1)) AS position,
         unnest(string_split(sequence, '')) AS aa
  FROM seqs
)"""

PROT = """
prot AS (
  SELECT DISTINCT pid, position FROM (
    SELECT doc_id AS pid, doc_id % 50 + 1 AS position FROM labels
    UNION ALL
    SELECT doc_id, doc_id % 50 + 2 + CAST(quality AS BIGINT) * 3 FROM labels)
)"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0"


def exact(expr: str, digits: int) -> str:
    """Rounded by the double's exact value, as printing it does."""
    return f"CAST(format('{{:.{digits}f}}', CAST({expr} AS DOUBLE)) AS DOUBLE)"


def letter(index: str) -> str:
    return f"substr('{AA}', CAST(({index}) % 20 + 1 AS INT), 1)"


DOCMUT = f"""
docmut AS (
  SELECT DISTINCT pid, set_id, position,
         CASE WHEN l_tax > 0.005 AND position <= length(sequence) THEN substr(sequence, position, 1)
              ELSE 'W' END AS wt,
         {letter('l_suppkey')} AS mut
  FROM (SELECT s.pid, l_orderkey AS set_id, sequence, l_tax, l_suppkey,
               (l_orderkey * 31 + l_linenumber * 7) % (length(sequence) + 2) + 1 AS position
        FROM lineitem JOIN seqs s ON s.pid = l_partkey)
)"""

TURNS = """
turns AS (
  SELECT * FROM (SELECT conv_id, CAST(turn AS BIGINT) AS turn,
         translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BJOUZ', '') AS sequence
  FROM conversations) WHERE length(sequence) > 0),
pairs AS (
  SELECT t.conv_id || ':' || t.turn AS pid, b.sequence AS parent_sequence, t.sequence
  FROM turns t JOIN turns b ON b.conv_id = t.conv_id AND b.turn + 1 = t.turn)"""

LINES = """
lines AS (
  SELECT doc_id, lang, doc_id * 1000000 + off AS rec_idx, substr(t, off * 60 + 1, 60) AS line
  FROM (SELECT doc_id, lang, t, unnest(range(0, (length(t) + 59) // 60)) AS off
        FROM (SELECT doc_id, lang, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')),
                                             'BJOUZ', '-----') AS t FROM documents))
)"""

MSA = """
msa AS (SELECT lang AS pid, rec_idx, rpad(line, 60, '-') AS aligned FROM lines),
wt AS (SELECT pid, min_by(aligned, rec_idx) AS aligned FROM msa GROUP BY pid),
cmap AS (
  SELECT pid, col, wt, row_number() OVER (PARTITION BY pid ORDER BY col) AS position
  FROM (SELECT pid, unnest(range(1, 61)) AS col, unnest(string_split(aligned, '')) AS wt FROM wt)
  WHERE wt <> '-'),
cells AS (
  SELECT pid, rec_idx, unnest(range(1, 61)) AS col, unnest(string_split(aligned, '')) AS aa FROM msa),
counts AS (
  SELECT c.pid, position, wt, aa, count(*) AS n, min(rec_idx) AS first_idx
  FROM cells c JOIN cmap m ON m.pid = c.pid AND m.col = c.col WHERE aa <> '-'
  GROUP BY c.pid, position, wt, aa)"""

CONSENSUS = """
ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY pid, position) AS depth,
         sum(CASE WHEN aa = wt THEN n ELSE 0 END) OVER (PARTITION BY pid, position) AS n_wt,
         row_number() OVER (PARTITION BY pid, position ORDER BY n DESC, first_idx) AS rn
  FROM counts),
calls AS (
  SELECT pid, position, wt, aa AS consensus, n / depth AS conservation, n_wt / depth AS wt_frequency,
         CAST(depth AS BIGINT) AS depth
  FROM ranked WHERE rn = 1 AND depth >= 3)"""

CONSMUT = """
cmut AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pid ORDER BY conservation DESC, position) AS rank
    FROM calls WHERE consensus <> wt AND conservation >= {cut}) WHERE rank <= 20)"""

PSSM = """
depth AS (
  SELECT m.pid, m.position, m.wt, coalesce(sum(n), 0) AS depth
  FROM cmap m LEFT JOIN counts c ON c.pid = m.pid AND c.position = m.position
       AND contains('ACDEFGHIKLMNPQRSTVWY', c.aa)
  GROUP BY m.pid, m.position, m.wt),
pssm AS (
  SELECT d.pid, d.position, d.wt, a.aa,
         log2((coalesce(c.n, 0) + 0.5::DOUBLE) / (depth + 10) * 20) AS log_odds
  FROM depth d CROSS JOIN (SELECT unnest(string_split('ACDEFGHIKLMNPQRSTVWY', '')) AS aa) a
  LEFT JOIN counts c ON c.pid = d.pid AND c.position = d.position AND c.aa = a.aa)"""
PSSMMUT = """
pmut AS (
  SELECT * FROM (
    SELECT p.pid, p.position, p.wt, p.aa AS mut, p.log_odds, coalesce(w.log_odds, 0) AS wt_log_odds,
           p.log_odds - coalesce(w.log_odds, 0) AS score,
           row_number() OVER (PARTITION BY p.pid
             ORDER BY round(p.log_odds - coalesce(w.log_odds, 0), 9) DESC, p.position, p.aa) AS rank
    FROM pssm p LEFT JOIN pssm w ON w.pid = p.pid AND w.position = p.position AND w.aa = p.wt
    WHERE p.aa <> p.wt AND round(p.log_odds - coalesce(w.log_odds, 0), 9) >= {cut})
  WHERE rank <= 30)"""

HOMOLOGS = """
hits AS (
  SELECT source AS pid, doc_id AS idx, CASE WHEN doc_id < 10 THEN 'query' ELSE CAST(doc_id AS VARCHAR) END AS name,
         translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BJOUXZ', '') AS sequence
  FROM documents),
body AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY idx) AS k FROM hits)
  WHERE length(sequence) > 0 AND NOT (k = 1 AND name IN ('query', '101'))),
uniq AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY pid, sequence ORDER BY idx) AS copy FROM body) WHERE copy = 1),
kept AS (SELECT pid, idx, name, sequence, row_number() OVER (PARTITION BY pid ORDER BY idx) AS rank FROM uniq)"""

RUN = f"""
rv AS (
  SELECT *, pid || ':' || step_no || ':' || wt || position || mut AS candidate_id,
         wt || position || mut AS label, cents / n::DOUBLE / 791900.0 - 6.3 AS score,
         CASE WHEN returned THEN disc / n::DOUBLE / 7.0 - 0.7 END AS e1_fitness,
         CASE WHEN final THEN tax / n::DOUBLE / 3.0 - 1.3 END AS esm1v_delta,
         CASE step_no WHEN 1 THEN 'cysteine_scan' WHEN 2 THEN 'motif_scan' WHEN 3 THEN 'consensus_design'
           WHEN 4 THEN 'pssm_analysis' WHEN 5 THEN 'cavity_fill' WHEN 6 THEN 'surface_patch'
           ELSE 'stability_ddg' END AS source_step,
         CASE step_no WHEN 1 THEN 'cys_risk' WHEN 2 THEN 'motif_risk_fixed' WHEN 3 THEN 'consensus_conservation'
           WHEN 4 THEN 'pssm_log_odds' WHEN 5 THEN 'cavity_burial' WHEN 6 THEN 'surface_sap'
           ELSE 'ddg' END AS own_key
  FROM (
    SELECT pid, CAST(l_linenumber AS BIGINT) AS step_no, position, wt, mut, count(*) AS n,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
           CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS disc,
           CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS tax,
           bool_or(l_returnflag = 'R') AS returned, bool_or(l_linestatus = 'F') AS final
    FROM (SELECT *, l_suppkey AS pid, l_partkey % 50 + 1 AS position,
                 {letter('l_suppkey * 7 + (l_partkey % 50 + 1) * 3')} AS wt,
                 {letter('CAST(l_quantity AS BIGINT)')} AS mut FROM lineitem)
    WHERE wt <> mut GROUP BY pid, l_linenumber, position, wt, mut))"""

RSCORES = """
rs AS (
  SELECT pid, candidate_id, step_no, own_key AS score_key, score AS value FROM rv
  UNION ALL SELECT pid, candidate_id, step_no, 'e1_fitness', e1_fitness FROM rv WHERE e1_fitness IS NOT NULL
  UNION ALL SELECT pid, candidate_id, step_no, 'esm1v_delta', esm1v_delta FROM rv WHERE esm1v_delta IS NOT NULL)"""

OSCORES = """
os AS (
  SELECT candidate_id,
         CASE l WHEN 1 THEN 'e1_fitness' WHEN 2 THEN 'esm1v_delta' WHEN 3 THEN 'ddg' WHEN 4 THEN 'surface_sap'
           WHEN 5 THEN 'mpnn_score' WHEN 6 THEN 'plddt' ELSE 'val_plddt' END AS score_key,
         CASE WHEN l = 6 THEN qty / n::DOUBLE * 2.0 WHEN l = 7 THEN qty / n::DOUBLE * 2.0 - 2.0
              ELSE cents / n::DOUBLE / 791900.0 - 6.3 END AS value
  FROM (SELECT l_orderkey AS candidate_id, l_linenumber AS l, count(*) AS n,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
        FROM lineitem GROUP BY l_orderkey, l_linenumber))"""

OCANDS = """
oc AS (
  SELECT o_custkey AS pid, o_orderkey AS candidate_id,
         CASE WHEN o_orderkey <> min(o_orderkey) OVER (PARTITION BY o_custkey)
              THEN min(o_orderkey) OVER (PARTITION BY o_custkey) END AS parent_id
  FROM orders)"""

OMUTS = f"""
om AS (
  SELECT DISTINCT l_orderkey AS candidate_id, l_partkey % 300 + 1 AS position,
         {letter('l_suppkey')} AS wt, {letter('CAST(l_quantity AS BIGINT)')} AS mut
  FROM lineitem WHERE {letter('l_suppkey')} <> {letter('CAST(l_quantity AS BIGINT)')})"""

COMPOSITE = """
wts(score_key, weight) AS (VALUES ('e1_fitness', 0.25), ('esm1v_delta', 0.20), ('esmif1_delta', 0.15),
  ('mpnn_score', 0.10), ('consensus_score', 0.10), ('pssm_delta', 0.10), ('ddg', 0.05),
  ('cavity_burial', 0.025), ('surface_sap', 0.025)),
st AS (SELECT score_key, avg(value) AS mean, stddev_pop(value) AS std, count(*) AS n
       FROM {src} GROUP BY score_key HAVING count(*) > 1),
comp AS (
  SELECT candidate_id, sum(weight::DOUBLE * z * sgn) / sum(weight::DOUBLE) AS composite FROM (
    SELECT s.candidate_id, w.weight,
           CASE WHEN st.std IS NULL THEN s.value WHEN st.std > 1e-8 THEN (s.value - st.mean) / st.std ELSE 0 END AS z,
           CASE WHEN s.score_key IN ('ddg', 'surface_sap') THEN -1 ELSE 1 END AS sgn
    FROM {src} s JOIN wts w USING (score_key) LEFT JOIN st USING (score_key)) GROUP BY candidate_id)"""


def _atom(name: str, first: int) -> str:
    return (f"SELECT *, '{name}' AS atom, '{name[0]}' AS element, embedding[{first + 1}]::DOUBLE * 40 AS x, "
            f"embedding[{first + 2}]::DOUBLE * 40 AS y, embedding[{first + 3}]::DOUBLE * 40 AS z FROM vecs")


ATOMS = f"""
vecs AS (
  SELECT vec_id, vec_id // 50 AS structure_id, vec_id % 50 + 1 AS position, embedding, label,
         {letter('vec_id * 7 + vec_id // 20')} AS aa, vec_id % 17 = 3 AS het,
         abs(embedding[13]::DOUBLE) * 100 + 60 AS bfactor FROM embeddings),
atoms AS (
  {_atom('N', 6)} UNION ALL {_atom('CA', 0)} WHERE vec_id % 23 <> 5
  UNION ALL {_atom('C', 9)} UNION ALL {_atom('CB', 3)} WHERE aa <> 'G'),
protres AS (SELECT structure_id, position FROM vecs WHERE label = 3),
pts AS (
  SELECT structure_id, position, aa,
         coalesce(max(x) FILTER (atom = 'CB'), max(x) FILTER (atom = 'CA')) AS bx,
         coalesce(max(y) FILTER (atom = 'CB'), max(y) FILTER (atom = 'CA')) AS by,
         coalesce(max(z) FILTER (atom = 'CB'), max(z) FILTER (atom = 'CA')) AS bz,
         max(x) FILTER (atom = 'CA') AS ax, max(y) FILTER (atom = 'CA') AS ay, max(z) FILTER (atom = 'CA') AS az
  FROM atoms WHERE NOT het AND atom IN ('CA', 'CB') GROUP BY structure_id, position, aa)"""

DISULFIDE = """
dist AS (
  SELECT a.structure_id, a.position AS i, b.position AS j, a.aa AS wt_i, b.aa AS wt_j,
         (a.bx - b.bx) ** 2 + (a.by - b.by) ** 2 + (a.bz - b.bz) ** 2 AS d2
  FROM pts a JOIN pts b ON a.structure_id = b.structure_id AND b.position - a.position >= 4
  WHERE (a.structure_id, a.position) NOT IN (SELECT (structure_id, position) FROM protres)
    AND (b.structure_id, b.position) NOT IN (SELECT (structure_id, position) FROM protres)),
ss AS (
  SELECT structure_id, i, j, wt_i, wt_j, sqrt(d2) AS distance, -2.0 + 5.0 * abs(sqrt(d2) - 3.8) AS energy,
         row_number() OVER (PARTITION BY structure_id ORDER BY abs(sqrt(d2) - 3.8), i, j) AS rank
  FROM dist WHERE d2 BETWEEN 12.25 AND 20.25 QUALIFY rank <= 10)"""

BURIAL = """
bur AS (
  SELECT a.structure_id, a.position, a.aa, count(DISTINCT b.position) - 1 AS contacts
  FROM atoms a JOIN atoms b ON a.structure_id = b.structure_id
   AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= 100
  WHERE a.atom = 'CA' AND NOT a.het AND a.aa IN ('G', 'A', 'V', 'S', 'T')
   AND (a.structure_id, a.position) NOT IN (SELECT (structure_id, position) FROM protres)
  GROUP BY a.structure_id, a.position, a.aa)"""

SASA = """
sph AS (SELECT i, sqrt(1 - z * z) * cos(i * pi() * (3 - sqrt(5))) AS ux,
               sqrt(1 - z * z) * sin(i * pi() * (3 - sqrt(5))) AS uy, z AS uz
        FROM (SELECT i, 1 - (2 * i + 1) / 100.0::DOUBLE AS z FROM (SELECT unnest(range(100)) AS i))),
rad AS (SELECT *, CASE element WHEN 'N' THEN 1.55 ELSE 1.7 END::DOUBLE + 1.4 AS r FROM atoms),
tp AS (SELECT structure_id, position, atom, r, i, x + r * ux AS px, y + r * uy AS py, z + r * uz AS pz FROM rad, sph),
hid AS (
  SELECT DISTINCT t.structure_id, t.position, t.atom, t.i
  FROM tp t JOIN rad b ON b.structure_id = t.structure_id AND (b.position <> t.position OR b.atom <> t.atom)
   AND (px - b.x) ** 2 + (py - b.y) ** 2 + (pz - b.z) ** 2 < b.r ** 2),
asa AS (
  SELECT r.structure_id, r.position, r.aa, r.het, r.atom,
         (100 - count(h.i)) * (4 * pi() / 100) * any_value(r.r) ** 2 AS sasa
  FROM rad r LEFT JOIN hid h ON h.structure_id = r.structure_id AND h.position = r.position AND h.atom = r.atom
  GROUP BY r.structure_id, r.position, r.aa, r.het, r.atom)"""

SURFACE = """
rsa AS (SELECT structure_id, position, aa, het, sum(sasa) AS sasa FROM asa GROUP BY ALL),
surf AS (
  SELECT structure_id, position, aa, sasa / CASE aa WHEN 'I' THEN 197 WHEN 'L' THEN 201 WHEN 'M' THEN 224
           WHEN 'F' THEN 240 WHEN 'V' THEN 174 ELSE 285 END AS exposure,
         exposure * CASE aa WHEN 'I' THEN 4.5 WHEN 'L' THEN 3.8 WHEN 'M' THEN 1.9 WHEN 'F' THEN 2.8
           WHEN 'V' THEN 4.2 ELSE -0.9 END::DOUBLE AS score
  FROM rsa WHERE NOT het AND aa IN ('I', 'L', 'M', 'F', 'V', 'W') AND round(exposure, 9) >= 0.25
   AND (structure_id, position) NOT IN (SELECT (structure_id, position) FROM protres))"""

PATCH = """
sp AS (SELECT s.*, ax, ay, az FROM surf s LEFT JOIN pts p ON p.structure_id = s.structure_id AND p.position = s.position),
edge AS (
  SELECT a.structure_id, a.position AS u, b.position AS v FROM sp a JOIN sp b
    ON a.structure_id = b.structure_id AND a.position <> b.position
  WHERE CASE WHEN a.ax IS NULL OR b.ax IS NULL THEN abs(a.position - b.position) <= 5
             ELSE (a.ax - b.ax) ** 2 + (a.ay - b.ay) ** 2 + (a.az - b.az) ** 2 <= 64 END),
reach AS (
  SELECT structure_id, position AS u, position AS v FROM sp
  UNION
  SELECT r.structure_id, r.u, e.v FROM reach r JOIN edge e ON e.structure_id = r.structure_id AND e.u = r.v),
lab AS (SELECT structure_id, u AS position, min(v) AS patch, count(*) AS patch_size FROM reach GROUP BY structure_id, u),
mem AS (SELECT s.structure_id, s.position, aa, exposure, score, patch, patch_size
        FROM surf s JOIN lab l ON l.structure_id = s.structure_id AND l.position = s.position WHERE patch_size >= 3)"""

RMSD = """
ord AS (SELECT structure_id, ax, ay, az, row_number() OVER (PARTITION BY structure_id ORDER BY position) AS k
        FROM pts WHERE ax IS NOT NULL),
sums AS (
  SELECT a.structure_id AS sa, b.structure_id AS sb, count(*)::DOUBLE AS n,
    sum(a.ax ** 2 + a.ay ** 2 + a.az ** 2) - (sum(a.ax) ** 2 + sum(a.ay) ** 2 + sum(a.az) ** 2) / count(*) AS ea,
    sum(b.ax ** 2 + b.ay ** 2 + b.az ** 2) - (sum(b.ax) ** 2 + sum(b.ay) ** 2 + sum(b.az) ** 2) / count(*) AS eb,
    sum(a.ax * b.ax) - sum(a.ax) * sum(b.ax) / count(*) AS h11, sum(a.ax * b.ay) - sum(a.ax) * sum(b.ay) / count(*) AS h12,
    sum(a.ax * b.az) - sum(a.ax) * sum(b.az) / count(*) AS h13, sum(a.ay * b.ax) - sum(a.ay) * sum(b.ax) / count(*) AS h21,
    sum(a.ay * b.ay) - sum(a.ay) * sum(b.ay) / count(*) AS h22, sum(a.ay * b.az) - sum(a.ay) * sum(b.az) / count(*) AS h23,
    sum(a.az * b.ax) - sum(a.az) * sum(b.ax) / count(*) AS h31, sum(a.az * b.ay) - sum(a.az) * sum(b.ay) / count(*) AS h32,
    sum(a.az * b.az) - sum(a.az) * sum(b.az) / count(*) AS h33
  FROM ord a JOIN ord b ON b.structure_id = a.structure_id + 1 AND b.k = a.k GROUP BY 1, 2),
mm AS (
  SELECT *, h11*h11+h21*h21+h31*h31 AS m11, h12*h12+h22*h22+h32*h32 AS m22, h13*h13+h23*h23+h33*h33 AS m33,
    h11*h12+h21*h22+h31*h32 AS m12, h11*h13+h21*h23+h31*h33 AS m13, h12*h13+h22*h23+h32*h33 AS m23,
    h11*(h22*h33-h23*h32) - h12*(h21*h33-h23*h31) + h13*(h21*h32-h22*h31) AS det, (m11+m22+m33)/3 AS q,
    sqrt(((m11-q)**2+(m22-q)**2+(m33-q)**2+2*(m12**2+m13**2+m23**2))/6) AS p,
    ((m11-q)*((m22-q)*(m33-q)-m23*m23) - m12*(m12*(m33-q)-m23*m13) + m13*(m12*m23-(m22-q)*m13)) / (2*p**3) AS r,
    acos(greatest(-1, least(1, r))) / 3 AS phi, q + 2*p*cos(phi) AS e1, q + 2*p*cos(phi + 2*pi()/3) AS e3
  FROM sums),
rm AS (SELECT sa, sb, n::BIGINT AS n_atoms, CASE WHEN n >= 10 THEN sqrt(greatest(0, (ea + eb - 2 * (sqrt(greatest(0, e1))
    + sqrt(greatest(0, 3*q-e1-e3)) + sign(det) * sqrt(greatest(0, e3)))) / n)) END AS rmsd FROM mm)"""

BSEQ = """
seqs AS (SELECT item_id AS pid,
  translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BJOUXZ', '') AS sequence FROM benchmark)"""

LOGPROBS = """
lps AS (
  SELECT pid, position, model, aa,
         -ln(1.0::DOUBLE + (position * 31 + ascii(aa) * 17 + pid * model) % 97) AS lp
  FROM (SELECT pid, position FROM res) CROSS JOIN (SELECT unnest([1, 2]) AS model)
  CROSS JOIN (SELECT unnest(string_split('ACDEFGHIKLMNPQRSTVWY', '')) AS aa))"""

BMUT = f"""
bmut AS (
  SELECT DISTINCT pid, set_id, position, wt, mut FROM (
    SELECT s.pid, l_orderkey AS set_id, l_partkey % length(sequence) + 1 AS position,
           substr(sequence, l_partkey % length(sequence) + 1, 1) AS wt, {letter('CAST(l_quantity AS BIGINT)')} AS mut
    FROM lineitem JOIN seqs s ON s.pid = l_suppkey) WHERE wt <> mut)"""

BVAR = """
vgood AS (
  SELECT pid, set_id, string_agg(wt || position || mut, ',' ORDER BY position, wt, mut) AS labels
  FROM bmut GROUP BY pid, set_id HAVING count(DISTINCT position) = count(*)),
vpieces AS (
  SELECT g.pid, g.set_id, labels, position, mut, sequence,
         coalesce(lag(position) OVER w, 0) AS prev, lead(position) OVER w AS nxt
  FROM vgood g JOIN bmut m ON m.pid = g.pid AND m.set_id = g.set_id JOIN seqs s ON s.pid = g.pid
  WINDOW w AS (PARTITION BY g.pid, g.set_id ORDER BY position)),
bvar AS (
  SELECT pid, set_id, labels, string_agg(substr(sequence, prev + 1, position - prev - 1) || mut
           || CASE WHEN nxt IS NULL THEN substr(sequence, position + 1) ELSE '' END, '' ORDER BY position) AS sequence
  FROM vpieces GROUP BY pid, set_id, labels)"""

TCAND = """
tc AS (
  SELECT source AS pid, doc_id AS candidate_id,
         CASE WHEN doc_id <> min(doc_id) OVER (PARTITION BY source) THEN min(doc_id) OVER (PARTITION BY source) END AS parent_id,
         translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BJOUXZ', '') AS sequence
  FROM documents)"""

VSEQ = """
vs AS (
  SELECT CAST(label AS BIGINT) AS pid, vec_id AS rank,
         array_to_string(list_transform(embedding, lambda e: substr('ACDEFGHIKLMNPQRSTVWY',
           CAST(greatest(1, least(20, floor((e::DOUBLE + 0.5) * 20) + 1)) AS INT), 1)), '') AS sequence
  FROM embeddings)"""
