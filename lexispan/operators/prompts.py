"""Ready-made chains: reply to a review, route a question, advertise a product.

The first templates below are fixed values, prompts and the names of their variables;
the routing, answering and advertising prompts are this package's own.
"""

from __future__ import annotations

from lexispan.operators.chains import Model, Stage

# Fixed values.
LANGUAGE = "Identify the language of the following: {review}"
TRANSLATE_REVIEW = "Translate the following from {language} into English: {review}"
SUMMARIZE = "Summarize the following: {english_review}"
REPLY = "Draft a reply to {review} in {language}, based on the summary: {summary}."
TRANSLATE_REPLY = "Translate the following from {language} into English: {followup_message}"

SUBJECTS = ["math", "history", "physics"]
PRODUCT_CATEGORIES = ["tech", "fashion", "home"]
OTHER = "None"

ROUTE = (
    "Choose the {kind} that fits the text best: {choices}. Choose None if none fits.\n"
    "Text: {{input}}\n"
    "Reply with a JSON object that has the string fields destination (the {kind}) "
    "and next_inputs (the text to pass on)."
)
ANSWER = "Answer as a {role} would, briefly and exactly.\nQuestion: {{input}}"
NAME = "Think of one short product name, as a {role}. The product: {{input}}"
ADVERTISE = "As a {role}, advertise {{name}} in a few sentences. The product: {{input}}"


def review_reply_chain(model: Model) -> list[Stage]:
    """Language, translation, summary, reply and its translation back."""
    return [
        Stage(LANGUAGE, model, "language"),
        Stage(TRANSLATE_REVIEW, model, "english_review"),
        Stage(SUMMARIZE, model, "summary"),
        Stage(REPLY, model, "followup_message"),
        Stage(TRANSLATE_REPLY, model, "English_followup_message"),
    ]


def router_stage(model: Model, kind: str, choices: list[str]) -> Stage:
    template = ROUTE.format(kind=kind, choices=", ".join(choices))
    return Stage(template, model, "route_reply")


def subject_chains(model: Model) -> dict[str, list[Stage]]:
    """One answering stage per subject, and one for everything else."""
    roles = {s: f"{s} professor" for s in SUBJECTS} | {OTHER: "professor"}
    return {
        subject: [Stage(ANSWER.format(role=role), model, "text")]
        for subject, role in roles.items()
    }


def product_chains(namer: Model, writer: Model) -> dict[str, list[Stage]]:
    """Name a product, then advertise it, per category; each stage has its model."""
    roles = {c: f"{c} business expert" for c in PRODUCT_CATEGORIES}
    roles[OTHER] = "general business expert"
    return {
        category: [
            Stage(NAME.format(role=role), namer, "name"),
            Stage(ADVERTISE.format(role=role), writer, "text"),
        ]
        for category, role in roles.items()
    }
