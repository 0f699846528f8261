"""Mail containers to an anonymised corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.functions.masks import mask_text, with_masked_text
from postsieve.functions.phrases import clean_mail, truncate
from postsieve.functions.rewrite import evaluated_once
from postsieve.operators.decoding import drop_undecoded, with_decoded_body, with_proposal
from postsieve.operators.dedup import keep_first
from postsieve.operators.filters import drop_senders, drop_subjects
from postsieve.operators.lexicon import drop_listed, mask_gazetteers
from postsieve.operators.profiling import StepReport
from postsieve.operators.spans import Entities, mask_entities
from postsieve.operators.tables import drop_columns
from postsieve.rules.domains import EXCLUDED_SUBJECTS
from postsieve.rules.phrase_rules import HouseTerms
from postsieve.schemas import CONTAINER_EXTRAS, MAIL_CORPUS_COLUMNS
from postsieve.sources.sinks import save_stage


def select_mails(
    container: DataFrame, blocklist: DataFrame | None = None,
    senders: DataFrame | None = None, order: tuple[str, ...] = ("file_seq", "row_seq"),
    steps: StepReport | None = None, subjects: Sequence[str] = EXCLUDED_SUBJECTS,
) -> DataFrame:
    """De-duplicated mails of relevant senders and subjects, columns pruned.

    The de-duplication finds repeated ids on narrow columns; no body is shuffled.
    """
    count = (lambda df, step: df) if steps is None else steps.count
    extras = [name for name in CONTAINER_EXTRAS if name not in order]
    mails = keep_first(drop_columns(container, extras), "message_id", *order)
    mails = count(mails, "first of each message id")
    if blocklist is not None:
        mails = count(drop_listed(mails, "from", blocklist, key="message_id"), "not on the blocklist")
    if senders is not None:
        mails = count(drop_senders(mails, senders), "of other senders")
    return count(drop_subjects(mails, subjects=subjects) if subjects else mails, "of other subjects")


def decode_mails(mails: DataFrame, other_charsets: bool = True) -> DataFrame:
    """Propose charsets, decode the bodies, drop what no charset fits."""
    decoded = with_decoded_body(with_proposal(mails), other_charsets=other_charsets)
    return drop_undecoded(decoded)


def _with_text(mails: DataFrame) -> DataFrame:
    return mails.drop("body").withColumnRenamed("body_dc", "body")


def decoded_mails(mails: DataFrame, other_charsets: bool = True) -> DataFrame:
    """Mails with their decoded text as ``body``, without those that no charset decodes."""
    return _with_text(decode_mails(mails, other_charsets))


def anonymise_mails(
    mails: DataFrame, house: HouseTerms = HouseTerms(), max_chars: int | None = None,
    compat: bool = True, lexicon: DataFrame | None = None, key: str = "message_id",
    entities: Entities | None = None,
) -> DataFrame:
    """Clean and mask mails with text ``body``; tag names, places and entity spans; truncate if asked to."""
    mails = clean_mail(mails, house, compat)
    mails = with_masked_text(mails.withColumn("subject", mask_text(F.col("subject"))), "body_clean")
    if lexicon is not None:
        for column in ("subject", "body_clean"):
            mails = mask_gazetteers(mails, column, lexicon, key)
    for column in ("subject", "body_clean"):
        mails = mask_entities(mails, column, entities)
    return mails.withColumn("body_clean", truncate(F.col("body_clean"), max_chars))


def undecoded_mails(mails: DataFrame, other_charsets: bool = True) -> DataFrame:
    """Selected mails whose body no charset decodes: what :func:`decode_mails` drops."""
    decoded = with_decoded_body(with_proposal(mails), other_charsets=other_charsets)
    decoded = decoded.withColumn("body_dc", evaluated_once(F.col("body_dc")))
    return decoded.filter(F.col("body_dc").isNull() & F.col("body").isNotNull()).drop("body_dc")


def build_mail_corpus(
    container: DataFrame, blocklist: DataFrame | None = None,
    senders: DataFrame | None = None, house: HouseTerms = HouseTerms(),
    max_chars: int | None = None, other_charsets: bool = True,
    order: tuple[str, ...] = ("file_seq", "row_seq"), stages: str | None = None,
    lexicon: DataFrame | None = None, entities: Entities | None = None, steps: StepReport | None = None,
) -> DataFrame:
    """The whole build; :func:`undecoded_mails` lists what it loses.

    One lazy plan behind the search for repeated ids.  With a folder in
    ``stages`` the selected and the decoded mails are written there, and each
    later step starts from the table.  ``entities`` gives the spans of a text
    column; ``steps`` counts the rows after every filter while the result runs.
    """
    mails = select_mails(container, blocklist, senders, order, steps)
    if stages:
        mails = save_stage(mails, stages, "selected")
    mails = decode_mails(mails, other_charsets)
    if steps is not None:
        mails = steps.count(mails, "decoded")
    if stages:
        mails = save_stage(mails, stages, "decoded")
    return anonymise_mails(_with_text(mails), house, max_chars, lexicon=lexicon, entities=entities).select(
        *[f"`{c}`" for c in MAIL_CORPUS_COLUMNS]
    )
