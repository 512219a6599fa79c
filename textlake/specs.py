"""Named datasets and cleaning switches."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields


# The defaults of the switches.
@dataclass(frozen=True)
class CleanConfig:
    """Switches of the cleaning chain; the defaults suit generic English."""

    lowercase: bool = True
    strip_html: bool = False
    strip_urls: bool = True
    strip_mentions: bool = False
    keep_hashtag_text: bool = True
    expand_contractions: bool = True
    reduce_repeats: bool = False
    remove_non_alpha: bool = True
    remove_stopwords: bool = True
    stem: bool = False
    lemmatize: bool = True
    min_token_len: int = 2
    extra_stopwords: frozenset[str] = field(default_factory=frozenset)
    keep_negations: bool = True
    unescape: bool = True

    def to_json(self) -> str:
        record = asdict(self)
        record["extra_stopwords"] = sorted(self.extra_stopwords)
        return json.dumps(record, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> CleanConfig:
        record = json.loads(text)
        unknown = set(record) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown cleaning switches: {sorted(unknown)}")
        record["extra_stopwords"] = frozenset(record.get("extra_stopwords", ()))
        return cls(**record)

    @property
    def reduction(self) -> str | None:
        """'stem', 'lemma' or None; stemming wins when both are switched on."""
        if self.stem:
            return "stem"
        return "lemma" if self.lemmatize else None


def default_config(**changes) -> CleanConfig:
    return CleanConfig(**changes)


def reviews_config(**changes) -> CleanConfig:
    """Long reviews that carry HTML."""
    return CleanConfig(**{"strip_html": True, **changes})


def tweets_config(**changes) -> CleanConfig:
    """Short noisy posts: mentions go, letter runs shrink."""
    return CleanConfig(**{"strip_mentions": True, "reduce_repeats": True, **changes})


@dataclass(frozen=True)
class DatasetSpec:
    """Where text and label sit in a raw table and what the labels mean."""

    name: str
    text_col: str
    label_col: str
    label_map: dict = field(default_factory=dict, hash=False)
    encoding: str = "UTF-8"
    header: bool = True
    columns: tuple[str, ...] | None = None
    domain: str = "generic"

    def clean_config(self, **changes) -> CleanConfig:
        preset = {"reviews": reviews_config, "tweets": tweets_config}
        return preset.get(self.domain, default_config)(**changes)


# Column names, label codes and encodings of two public datasets.
AMAZON = DatasetSpec(
    name="amazon_fine_food",
    text_col="Text",
    label_col="Score",
    label_map={1: 0, 2: 0, 4: 1, 5: 1},
    encoding="UTF-8",
    domain="reviews",
)
SENTIMENT140 = DatasetSpec(
    name="sentiment140",
    text_col="text",
    label_col="target",
    label_map={0: 0, 4: 1},
    encoding="ISO-8859-1",
    header=False,
    columns=("target", "ids", "date", "flag", "user", "text"),
    domain="tweets",
)

DATASETS = {spec.name: spec for spec in (AMAZON, SENTIMENT140)}


def get_dataset(name: str) -> DatasetSpec:
    try:
        return DATASETS[name]
    except KeyError:
        raise KeyError(f"unknown dataset {name!r}; known: {sorted(DATASETS)}") from None
