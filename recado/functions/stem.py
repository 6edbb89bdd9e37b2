"""Portuguese suffix stripping (Orengo and Huyck, "A Stemming Algorithm for the Portuguese Language",
SPIRE 2001) as one regular expression per step over a whole sentence.

In each step a word loses the longest listed suffix that leaves at least ``min_stem`` letters, unless
the word is an exception. Plural, feminine, augmentative and adverb steps follow each other; then the
noun step, the verb step if the noun step changed nothing, and the vowel step if neither did.

Sentences reach the stemmer without accents, so suffixes and exceptions that carry one are left out,
but for those that the feminine step itself brings back (``-ona`` to ``-ão``, ``-esa`` to ``-ês``).
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = ("plural", "feminine", "augmentative", "adverb", "noun", "verb", "vowel")
EXCLUSIVE = ("noun", "verb", "vowel")  # a word changed by one of these is done
DONE = "\x01"


@dataclass(frozen=True)
class StemRule:
    step: str
    suffix: str
    min_stem: int
    replacement: str = ""
    exceptions: tuple[str, ...] = ()


# Published rules, one per line: suffix, least stem, '>replacement' if any, exceptions.
PORTUGUESE = {
    "plural": """
        ns 1 >m
        ais 1 >al cais mais
        eis 2 >el
        is 2 >il cais mais pois depois dois leis
        les 3 >l
        res 3 >r
        s 2 pires cais mais mas menos fezes ambas ambos messias
    """,
    "feminine": """
        ona 3 >ão abandona lona iona cortisona maratona acetona detona carona
        ora 3 >or
        na 4 >no carona abandona lona iona cortisona maratona acetona detona guiana campana grana caravana banana paisana
        inha 3 >inho rainha linha minha
        esa 3 >ês mesa obesa princesa turquesa ilesa pesa presa
        osa 3 >oso mucosa prosa
        ica 3 >ico dica
        ada 2 >ado pitada
        ida 3 >ido vida
        ima 3 >imo
        iva 3 >ivo saliva oliva
        eira 3 >eiro beira cadeira frigideira bandeira feira capoeira barreira fronteira besteira poeira
    """,
    "augmentative": """
        zinho 2
        quinho 4 >c
        uinho 4
        adinho 3
        inho 3 caminho cominho
        alhão 4
        adão 4
        idão 4
        arraz 4
        zarrão 3
        arrão 4
        arra 3
        zão 2 coalizão
        ão 3 campeão capitão folião barão patrão leão
    """,
    "adverb": """
        mente 4 experimente
    """,
    "noun": """
        encialista 4
        alista 5
        agem 3 coragem chantagem vantagem carruagem
        iamento 4
        amento 3 firmamento fundamento departamento
        imento 3
        mento 6 firmamento elemento complemento instrumento departamento
        alizado 4
        atizado 4
        tizado 4 alfabetizado
        izado 5 organizado pulverizado
        ativo 4 pejorativo relativo
        tivo 4 relativo
        ivo 4 passivo possessivo pejorativo positivo
        ado 2 grado
        ido 3 consolido decido duvido marido
        ador 3
        edor 3
        idor 4 ouvidor
        dor 4 ouvidor
        sor 4 assessor
        atoria 5
        tor 3 benfeitor leitor editor pastor produtor promotor consultor
        or 2 motor melhor redor rigor sensor tambor tumor assessor benfeitor pastor terior favor autor
        abilidade 5
        icionista 4
        cionista 5
        ionista 5
        ionar 5
        ional 4
        edouro 3
        queiro 3 >c
        adeiro 4 desfiladeiro
        eiro 3 desfiladeiro pioneiro mosteiro
        uoso 3
        oso 3 precioso
        ês 4
        eza 3
        ez 4
        esco 4
        ante 2 gigante elefante adiante possante instante restaurante
        tico 3 diagnostico
        ico 4 tico explico
        ividade 5
        idade 4 autoridade comunidade
        oria 4 categoria
        encial 5
        ista 4
        auta 5
        quice 4 >c
        ice 4
        ente 4 alimente acrescente permanente oriente aparente
        ense 5
        inal 3
        ano 4
        vel 5
        bil 3 >vel
        ura 4 imatura acupuntura costura
        ural 4
        ual 3 bissexual virtual visual pontual
        ial 3
        al 4 afinal animal estatal bissexual desleal fiscal formal pessoal liberal postal virtual visual pontual sideral sucursal
        alismo 4
        ivismo 4
        ismo 3 cinismo
    """,
    "verb": """
        aremo 2
        ariam 2
        assem 2
        eremo 3
        eriam 3
        essem 3
        iremo 3
        iriam 3
        issem 3
        ando 2
        endo 3
        indo 3
        ondo 3
        aram 2
        arde 2
        arei 2
        arem 2
        aria 2
        armo 2
        asse 2
        aste 2
        avam 2 agravam
        eram 3
        erde 3
        erei 3
        erem 3
        eria 3
        ermo 3
        esse 3
        este 3 faroeste agreste
        iram 3
        irde 2
        irei 3 admirei
        irem 3 adquirem
        iria 3
        irmo 3
        isse 3
        iste 4
        iava 4 ampliava
        amo 2
        iona 3
        ara 2 arara prepara
        are 2 prepare
        ava 2 agrava
        emo 2
        era 3 acelera espera
        ere 3 espere
        iam 3 enfiam ampliam elogiam ensaiam
        imo 3 reprimo intimo nimo queimo ximo
        ira 3 fronteira
        tizar 4 alfabetizar
        izar 5 organizar
        itar 5 acreditar explicitar estreitar
        ire 3 adquire
        omo 3
        ai 2
        am 2
        ear 4 alardear nuclear
        ar 2 azar bazaar patamar
        uei 3
        ei 3
        guem 3 >g
        em 2 alem virgem
        er 2 pier
        eu 3 chapeu
        ia 3 fatia acia praia elogia mania aprecia arredia cheia
        ir 3 freir
        iu 3
        eou 5
        ou 3
        i 3
    """,
    "vowel": """
        bil 2 >vel
        gue 2 >g gangue jegue
        a 3
        e 3
        o 3
    """,
}


def read_rules(steps: dict[str, str]) -> tuple[StemRule, ...]:
    """Rules from the line format above."""
    rules = []
    for step, lines in steps.items():
        for line in filter(None, map(str.strip, lines.splitlines())):
            suffix, least, *rest = line.split()
            replacement = rest.pop(0)[1:] if rest and rest[0].startswith(">") else ""
            rules.append(StemRule(step, suffix, int(least), replacement, tuple(rest)))
    return tuple(rules)


def _change(rule: StemRule) -> tuple[str, str]:
    """What a rule takes off the end of its suffix and what it puts there: ``-osa`` to ``-oso`` is (a, o)."""
    kept = len(os.path.commonprefix([rule.suffix, rule.replacement]))
    return rule.suffix[kept:], rule.replacement[kept:]


def _run_key(rule: StemRule) -> tuple[str, str]:
    """Rules of one key share a regular expression: they put the same text in place of what they take off,
    which is a whole suffix, or else the same letters."""
    off, on = _change(rule)
    return ("" if off == rule.suffix else off), on


def _runs(rules: Sequence[StemRule]) -> list[list[StemRule]]:
    """Split one step into as few regular expressions as its replacements allow.

    A rule must come after every rule with a longer suffix that ends in its own, or share its run: the
    leftmost match in a word is then the longest suffix, or all matches make the same change.
    """
    runs: list[list[StemRule]] = []
    at: dict[StemRule, int] = {}
    for rule in sorted(rules, key=lambda r: -len(r.suffix)):
        first = 0
        for longer, run in at.items():
            if longer.suffix.endswith(rule.suffix):
                first = max(first, run + (_run_key(longer) != _run_key(rule)))
        for run in range(first, len(runs)):
            if _run_key(runs[run][0]) == _run_key(rule):
                break
        else:
            runs.append([])
            run = len(runs) - 1
        runs[run].append(rule)
        at[rule] = run
    return runs


def _pattern(rules: Sequence[StemRule]) -> str:
    """Of a text written backwards in which a space stands before each word: a suffix is looked for where a word begins, and nowhere else.

    Rules of a run come longest suffix first, so the first that fits is the longest.
    """
    by_letter: dict[str, list[str]] = {}
    for rule in rules:
        off, _ = _change(rule)
        kept = rule.suffix[:len(rule.suffix) - len(off)]
        part = rf"{off[-2::-1]}(?={kept[::-1]}[^ ]{{{rule.min_stem}}})"
        rest = [x[:len(x) - len(off)][::-1] for x in rule.exceptions if x.endswith(off)]
        if rest:
            part += f"(?!(?:{'|'.join(rest)})(?![^ ]))"
        by_letter.setdefault(off[-1], []).append(part)
    return " (?:" + "|".join(f"{letter}(?:{'|'.join(parts)})" for letter, parts in by_letter.items()) + ")"


def stem(text: Column, rules: Sequence[StemRule]) -> Column:
    """Stem every word of a text whose words are separated by single spaces."""
    text = F.concat(F.lit(" "), F.reverse(text))
    for step in STEPS:
        in_step = [r for r in rules if r.step == step]
        if not in_step:
            continue
        for run in _runs(in_step):
            text = F.regexp_replace(text, _pattern(run), " " + DONE + _change(run[0])[1][::-1])
        if step not in EXCLUSIVE:
            text = F.replace(text, F.lit(DONE), F.lit(""))
    return F.reverse(F.substring(F.replace(text, F.lit(DONE), F.lit("")), 2, 2**31 - 1))
