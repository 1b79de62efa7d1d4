"""The queries of this subpackage, and their SQL where SQL can express them."""

from . import decontamination, language_id, metric_tree, near_duplicates, repeats, secrets, sentencepieces, token_files, url_reputation, warc


def queries() -> dict:
    return {
        "op1_language_id": language_id.op1_language_id,
        "op2_url_reputation": url_reputation.op2_url_reputation,
        "op3_secrets": secrets.op3_secrets,
        "op4_top_k": metric_tree.op4_top_k,
        "op5_warc": warc.op5_warc,
        "op6_repeats": repeats.op6_repeats,
        "op7_sentencepiece": sentencepieces.op7_sentencepiece,
        "op8_decontamination": decontamination.op8_decontamination,
        "op9_near_duplicates": near_duplicates.op9_near_duplicates,
        "op10_token_files": token_files.op10_token_files,
    }


def oracle_sql() -> dict:
    return {"op2_url_reputation": url_reputation.OP2_SQL, "op4_top_k": metric_tree.OP4_SQL, "op5_warc": warc.OP5_SQL, "op8_decontamination": decontamination.OP8_SQL}
