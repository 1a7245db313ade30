"""Skills: vocabulary search and required / optional sections.

No row is exploded and nothing is shuffled. The text is cut into paragraphs, each paragraph that
opens a section is marked with a control character, and the two kinds of section are then two
strings, each searched once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions.matching import bounded, bounded_groups, hits, string_array, string_map
from hirelens.functions.text import bind, is_blank

_REQUIRED, _OPTIONAL = "\x02", "\x03"


def find_skills(
    text: Column,
    skills=rules.SKILLS,
    bounded_up_to: int = rules.SKILL_BOUNDED_UP_TO,
    bounded_only: bool = False,
) -> Column:
    """Sorted canonical skills named in ``text``.

    Spellings longer than ``bounded_up_to`` count wherever they occur, also inside words;
    ``bounded_only=True`` asks for a non-letter on both sides of every spelling.
    """
    canonical = string_map(skills)

    def search(low: Column) -> Column:
        if bounded_only:
            found = F.array_compact(
                F.array(*[F.when(low.rlike(bounded(v)), F.lit(v)) for v, _ in skills])
            )
        else:
            short = [v for v, _ in skills if len(v) <= bounded_up_to]
            found = F.concat(
                hits(low, _needed([(v, c) for v, c in skills if len(v) > bounded_up_to])),
                *[
                    F.array_distinct(F.regexp_extract_all(low, F.lit(p), F.lit(1)))
                    for p in bounded_groups(short)
                ],
            )
        return F.transform(found, lambda v: F.element_at(canonical, v))

    return F.coalesce(
        F.array_sort(F.array_distinct(bind(F.lower(text), search))),
        F.array().cast("array<string>"),
    )


def _needed(plain) -> list[str]:
    """Spellings without those that contain another spelling of the same skill."""
    return [
        v for v, c in plain if not any(c == other and w != v and w in v for w, other in plain)
    ]


def split_paragraphs(text: Column) -> Column:
    """Cut at blank lines and at line breaks before a capital letter or a bullet."""
    return F.split(text, r"\n{2,}|\n(?=[A-Z•●■-])")


def _by_label(paragraph: Column, required: str, optional: str, other: str | None) -> Column:
    head = F.substring(paragraph, 1, rules.HEADING_WINDOW)
    return (
        F.when(head.rlike(f"(?iud)({rules.REQUIRED_HEADING})"), F.lit(required))
        .when(head.rlike(f"(?iud)({rules.OPTIONAL_HEADING})"), F.lit(optional))
        .otherwise(F.lit(other))
    )


def section_label(paragraph: Column) -> Column:
    """``required`` / ``optional`` when the paragraph opens such a section, else null."""
    return _by_label(paragraph, "required", "optional", None)


def section_texts(description: Column) -> Column:
    """``struct(required, optional)``: the paragraphs under each kind of heading.

    A heading holds until the next one; before the first heading everything is required.
    """

    def marked(paragraph: Column) -> Column:
        mark = _by_label(paragraph, _REQUIRED, _OPTIONAL, "\n")
        return F.concat(mark, paragraph)

    # translate looks at every character, so only texts that need it go through it
    has_marks = description.contains(_REQUIRED) | description.contains(_OPTIONAL)
    masked = F.translate(description, _REQUIRED + _OPTIONAL, "\x01\x01")
    clean = F.when(has_marks, masked).otherwise(description)
    whole = F.array_join(F.transform(split_paragraphs(clean), marked), "")
    def without(kind: str, other: str, marked_text: Column) -> Column:
        """The text minus every run from a mark of one kind to the next of the other."""
        rest = F.regexp_replace(marked_text, f"{kind}[^{other}]*", "\n")
        return F.replace(rest, F.lit(other), F.lit("\n"))

    return bind(
        whole,
        lambda t: F.struct(
            without(_OPTIONAL, _REQUIRED, t).alias("required"),
            without(_REQUIRED, _OPTIONAL, F.concat(F.lit(_REQUIRED), t)).alias("optional"),
        ),
    )


def extract_skills(description: Column, skills=rules.SKILLS, tools=rules.TOOLS, **search) -> Column:
    """``struct(skills_required, skills_optional, tools_frameworks)``, each sorted.

    A skill named in both kinds of section is required; when only optional ones are found
    they are required.
    """
    none = F.array().cast("array<string>")

    def combine(required: Column, optional: Column) -> Column:
        only_optional = F.size(required) == 0
        return F.struct(
            F.when(only_optional, optional).otherwise(required).alias("skills_required"),
            F.when(only_optional, none)
            .otherwise(F.array_except(optional, required))
            .alias("skills_optional"),
            F.array_sort(
                F.array_intersect(F.array_union(required, optional), string_array(tools))
            ).alias("tools_frameworks"),
        )

    def search_both(texts: Column) -> Column:
        return bind(
            F.struct(
                find_skills(texts["required"], skills, **search).alias("r"),
                find_skills(texts["optional"], skills, **search).alias("o"),
            ),
            lambda found: combine(found["r"], found["o"]),
        )

    return F.when(
        is_blank(description),
        F.struct(
            none.alias("skills_required"),
            none.alias("skills_optional"),
            none.alias("tools_frameworks"),
        ),
    ).otherwise(bind(section_texts(description), search_both))


def skill_union(required: Column, optional: Column) -> Column:
    return F.array_sort(F.array_union(required, optional))
