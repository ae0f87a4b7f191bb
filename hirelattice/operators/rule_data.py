"""Keyword rules of the three label matchers, as data."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """A clue for one label: any keyword found in its field."""

    name: str
    labels: tuple[str, ...]
    keywords: dict[str, tuple[str, ...]]


@dataclass(frozen=True)
class RuleSet:
    """Rules in falling priority; the label itself is first looked for in two fields."""

    exact_field: str
    partial_field: str
    rules: tuple[Rule, ...]


# The keywords and their priorities.
CONTRACT_RULES = RuleSet("contract_type", "description", (
    Rule("alternance", ("alternance",), {"description": (
        "alternance", "apprentissage", "contrat d'apprentissage", "contrat de professionnalisation")}),
    Rule("stage", ("stage",), {"description": ("stage", "internship", "stagiaire", "stage de fin d'études")}),
    Rule("cdi", ("cdi",), {
        "description": ("cdi", "durée indéterminée", "contrat à durée indéterminée", "permanent", "embauche",
                        "poste permanent"),
        "contract_type": ("cdi",),
        "contract_duration": ("contrat à durée indéterminée", "cdi")}),
    Rule("cdd", ("cdd",), {
        "description": ("cdd", "durée déterminée", "contrat à durée déterminée", "mission de"),
        "contract_type": ("cdd",),
        "contract_duration": ("cdd", "contrat à durée déterminée")}),
    Rule("interim", ("intérim", "interim"), {
        "description": ("intérim", "intérimaire", "interim", "temporaire", "travail temporaire", "agence d'intérim"),
        "contract_type": ("intérim", "interim"),
        "contract_duration": ("intérim", "intérimaire")}),
    Rule("freelance", ("freelance",), {
        "description": ("libéral", "liberal", "indépendant", "independant", "auto-entrepreneur", "auto entrepreneur",
                        "portage salarial"),
        "contract_type": ("freelance", "liberal", "libéral"),
        "contract_duration": ("franchise",)}),
))

SENIORITY_RULES = RuleSet("experience_required", "description", (
    Rule("senior", ("senior",), {
        "description": ("senior", "expert", "5 ans minimum", "5 ans d'expérience", "5 ans d'experience",
                        "plus de 5 ans"),
        "experience_required": ("expérience exigée", "experience exigee")}),
    Rule("confirmed", ("confirmé",), {
        "description": ("confirmé", "confirme", "expérimenté", "experimente", "2 à 5 ans", "2 a 5 ans", "2-5 ans"),
        "experience_required": ("expérience souhaitée", "experience souhaitee")}),
    Rule("junior", ("junior",), {
        "description": ("junior", "débutant", "debutant", "première expérience", "premiere experience",
                        "premier emploi"),
        "experience_required": ("débutant accepté", "debutant accepte", "expérience exigée", "experience exigee")}),
))

REMOTE_RULES = RuleSet("description", "description", (
    Rule("remote", ("à distance",), {"description": (
        "télétravail", "teletravail", "remote", "à distance", "a distance", "100% remote", "full remote",
        "travail à distance", "travail a distance", "travail depuis chez vous", "travail depuis la maison",
        "travail depuis votre domicile", "travail depuis le domicile", "travail en remote", "travail en télétravail",
        "travail en teletravail", "travail en distanciel", "travail à domicile", "travail a domicile",
        "travail depuis n'importe où", "travail depuis n'importe ou", "travail depuis partout",
        "travail depuis votre lieu de vie", "travail depuis votre lieu de residence", "travail depuis votre residence",
        "travail depuis votre maison", "travail depuis votre foyer", "travail depuis votre chez vous")}),
    Rule("site", ("sur site",), {"description": (
        "sur site", "présentiel", "presentiel", "au bureau", "dans nos locaux", "dans nos bureaux",
        "dans notre siège", "dans notre siege")}),
    Rule("hybrid", ("hybride",), {"description": (
        "hybride", "mixte", "flexible",
        "2-3 jours", "2 à 3 jours", "2 a 3 jours", "2/3 jours", "2 ou 3 jours",
        "2-3 jours par semaine", "2 à 3 jours par semaine", "2 a 3 jours par semaine", "2/3 jours par semaine",
        "2 ou 3 jours par semaine",
        "2-3 jours de télétravail", "2 à 3 jours de télétravail", "2 a 3 jours de télétravail",
        "2/3 jours de télétravail", "2 ou 3 jours de télétravail",
        "2-3 jours de teletravail", "2 à 3 jours de teletravail", "2 a 3 jours de teletravail",
        "2/3 jours de teletravail", "2 ou 3 jours de teletravail",
        "2-3 jours de remote", "2 à 3 jours de remote", "2 a 3 jours de remote", "2/3 jours de remote",
        "2 ou 3 jours de remote",
        "2-3 jours de télétravail par semaine", "2 à 3 jours de télétravail par semaine",
        "2 a 3 jours de télétravail par semaine", "2/3 jours de télétravail par semaine",
        "2 ou 3 jours de télétravail par semaine",
        "2-3 jours de teletravail par semaine", "2 à 3 jours de teletravail par semaine",
        "2 a 3 jours de teletravail par semaine", "2/3 jours de teletravail par semaine",
        "2 ou 3 jours de teletravail par semaine",
        "2-3 jours de remote par semaine", "2 à 3 jours de remote par semaine", "2 a 3 jours de remote par semaine",
        "2/3 jours de remote par semaine", "2 ou 3 jours de remote par semaine")}),
))
