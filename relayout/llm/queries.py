"""The registered queries of this subpackage and the SQL twins of those that SQL expresses."""

from . import bpe, fim, hosts, jaccard, language, lines, mixing, neighbours, ppm, resample, secrets, simplex, toxicity

QUERIES = {
    "op1_line_dedup": lines.query,
    "op2_importance_resampling": resample.query,
    "op3_jaccard_join": jaccard.query,
    "op4_language": language.query,
    "op5_mixing": mixing.query,
    "op6_neighbours": neighbours.query,
    "op7_toxicity": toxicity.query,
    "op8_secrets": secrets.query,
    "op9_host_rules": hosts.query,
    "op10_bpe": bpe.query,
    "op11_ppm": ppm.query,
    "op12_simplex_clusters": simplex.query,
    "op13_fill_in_middle": fim.query,
}

SQL = {
    "op1_line_dedup": lines.SQL,
    "op5_mixing": mixing.SQL,
    "op12_simplex_clusters": simplex.SQL,
    "op13_fill_in_middle": fim.SQL,
}
