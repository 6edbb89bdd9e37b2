"""Customer comments to labelled tables, on Spark: public functions."""

from recado.operators.abbreviations import learn_abbreviations
from recado.operators.labels import finish_results, label_comments
from recado.operators.modes import attach_user_problem, replay_problem_mode, user_problem_mode
from recado.operators.naming import build_lookup
from recado.operators.upsert import upsert_results
from recado.operators.vectors import assign_clusters
from recado.plans.classify import by_model, classify, replay
from recado.plans.clean import clean, clean_tagged, clean_trace, learn_context
from recado.plans.report import clean_report
from recado.plans.train import audit_taxonomy, predict, train
from recado.profiles import PT, PT_TAXONOMY, LanguageProfile, Lemma, Taxonomy
from recado.sources.files import read_comments, write_results
from recado.sources.interactions import extract_comments, extract_landed, land_interactions
from recado.sources.lexicon import read_conllu, read_lexicon
from recado.sources.models import load_newest, register
from recado.sources.store import merge_into_store, read_store

__all__ = [
    "PT", "PT_TAXONOMY", "LanguageProfile", "Lemma", "Taxonomy", "assign_clusters", "attach_user_problem",
    "audit_taxonomy", "build_lookup", "by_model", "classify", "clean", "clean_report", "clean_tagged", "clean_trace",
    "extract_comments", "extract_landed", "finish_results", "label_comments", "land_interactions", "learn_abbreviations", "learn_context", "load_newest", "merge_into_store", "predict",
    "read_comments", "read_conllu", "read_lexicon", "read_store", "register",
    "replay", "replay_problem_mode", "train", "upsert_results", "user_problem_mode", "write_results",
]
