"""The operators and the pipeline as registered queries, with SQL where SQL can express them."""

import corpus_pipeline
import public_tokenizers

from rastro.llm.bpe import bpe_report
from rastro.llm.decontamination import REPORT_SQL as DECONTAMINATION_SQL
from rastro.llm.decontamination import contamination_report
from rastro.llm.html import page_report
from rastro.llm.language import language_report
from rastro.llm.lm import REPORT_SQL as LM_SQL
from rastro.llm.lm import score_report
from rastro.llm.mixing import mixing_report
from rastro.llm.pii import personal_data_report
from rastro.llm.quality import quality_report
from rastro.llm.resampling import REPORT_SQL as RESAMPLING_SQL
from rastro.llm.resampling import resampling_report
from rastro.llm.search import REPORT_SQL as SEARCH_SQL
from rastro.llm.search import search
from rastro.llm.secrets import secret_report
from rastro.llm.simhash import near_duplicate_report
from rastro.llm.suffixes import repeat_report

QUERIES = {}
ORACLES = {}


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def query(name, sql=None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_secret_scans")
def op1_secret_scans(spark, sf_dir):
    return secret_report(_read(spark, sf_dir, "documents"))


@query("op2_benchmark_decontamination", DECONTAMINATION_SQL)
def op2_benchmark_decontamination(spark, sf_dir):
    return contamination_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@query("op3_suffix_array_dedup")
def op3_suffix_array_dedup(spark, sf_dir):
    return repeat_report(_read(spark, sf_dir, "documents"))


@query("op4_html_extraction")
def op4_html_extraction(spark, sf_dir):
    return page_report(_read(spark, sf_dir, "pages"))


@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_report(_read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op6_language_id")
def op6_language_id(spark, sf_dir):
    return language_report(_read(spark, sf_dir, "documents"))


@query("op7_simhash")
def op7_simhash(spark, sf_dir):
    return near_duplicate_report(_read(spark, sf_dir, "documents"))


@query("op8_pii")
def op8_pii(spark, sf_dir):
    return personal_data_report(_read(spark, sf_dir, "documents"))


@query("op9_lm_scoring", LM_SQL)
def op9_lm_scoring(spark, sf_dir):
    return score_report(_read(spark, sf_dir, "documents"))


@query("op10_quality_rules")
def op10_quality_rules(spark, sf_dir):
    return quality_report(_read(spark, sf_dir, "documents"))


@query("op11_source_mixing")
def op11_source_mixing(spark, sf_dir):
    return mixing_report(_read(spark, sf_dir, "documents"))


@query("op12_ranked_search", SEARCH_SQL)
def op12_ranked_search(spark, sf_dir):
    return search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


@query("op13_importance_resampling", RESAMPLING_SQL)
def op13_importance_resampling(spark, sf_dir):
    return resampling_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
