"""Language profiles: lexicons and limits as data. Another language or brand is another profile."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import StopWordsRemover

from recado.functions.stem import PORTUGUESE, StemRule, read_rules
from recado.functions.text import NO_LETTER


@dataclass(frozen=True)
class Lemma:
    """One dictionary entry. A word with several lemmas gets the smallest, unless a `ContextLexicon` chooses."""

    surface: str
    pos: str
    lemma: str


@dataclass(frozen=True)
class LanguageProfile:
    name: str
    brand: str
    brand_aliases: tuple[str, ...] = ()  # older or misspelt brand names, replaced by the brand
    stop_words: tuple[str, ...] = ()
    stop_language: str | None = None  # take Spark's own list of this language as the base
    keep_words: tuple[str, ...] = ()  # taken off the stop list
    extra_stop_words: tuple[str, ...] = ()
    synonyms: tuple[tuple[str, str], ...] = ()
    mandatory: tuple[str, ...] = ()
    blacklist: tuple[str, ...] = ()
    useless: tuple[str, ...] = ()
    lemma_exempt: tuple[str, ...] = ()
    lemmas: tuple[Lemma, ...] = ()
    stem_rules: tuple[StemRule, ...] = field(default=(), repr=False)
    lower_limit: int = 3
    upper_limit: int = 15
    abbreviations: tuple[str, ...] = ()  # words, without their last stop, whose stop ends no sentence (`learn_abbreviations`)

    def with_brand(self, brand: str) -> LanguageProfile:
        return replace(self, brand=brand)

    def all_stop_words(self) -> list[str]:
        """Base list, less the words to keep, plus the extra ones. Needs a running session
        when the base list is Spark's own."""
        base = list(self.stop_words)
        if self.stop_language:
            base = StopWordsRemover.loadDefaultStopWords(self.stop_language) + base
        kept = [w for w in base if w not in self.keep_words]
        return list(dict.fromkeys([*kept, *self.extra_stop_words]))

    def synonym_rules(self) -> list[tuple[str, str]]:
        """The ordered rules, with brand aliases right after the brand's own rule."""
        at = next((i + 1 for i, (old, _) in enumerate(self.synonyms) if old == self.brand), 0)
        aliases = [(alias, self.brand) for alias in self.brand_aliases]
        return [*self.synonyms[:at], *aliases, *self.synonyms[at:]]

    def lemma_map(self) -> dict[str, str]:
        """Surface to lemma for verbs, adjectives and nouns that are not exempt; the smallest of a surface's lemmas."""
        entries = [(e.surface, e.lemma) for e in self.lemmas if e.pos in LEMMATISED and e.surface not in self.lemma_exempt]
        return dict(sorted(entries, reverse=True))


LEMMATISED = ("VERB", "ADJ", "NOUN")


# Fixed values of the Portuguese profile ---------------------------------------------------------

# Words that are on the stop list but carry meaning here, and words missing from it.
PT_KEEP_WORDS = ("como", "nem", "não", "mais", "que", "está", "foi", "será", "quando", "tive", "até", "sem")
PT_EXTRA_STOP_WORDS = ("pra", "para")

# Ordered literal replacements, applied to unaccented lemmas; edge spaces count.
PT_SYNONYMS = (
    (" n ", " nao "),
    ("otima", "bom"),
    ("otimo", "bom"),
    ("excelente", "bom"),
    (" q ", " que "),
    (" pq ", " porque "),
    (" p ", " para "),
    ("por que", "porque"),
    ("pf ", "por favor "),
    ("pfv ", "por favor "),
    ("pfvr", "por favor "),
    ("poblem", "problem"),
    ("hj", "hoje"),
    ("oque", "o que"),
    ("extorno", "estorno"),
    (" nd ", " nada "),
    ("ctt", "contato"),
    ("efetivar", "fazer"),
    ("aki", "aqui"),
    ("agr ", "agora "),
    ("aguard", "esper"),
    ("relatar", "comentario"),
    ("voucher", "vale"),
    ("efetuar", "fazer"),
    ("whats ", "whatsapp "),
    ("ngm", "ninguem"),
    ("tbm", "tambem"),
    ("mto", "muito"),
    ("vcs", "voces"),
    (" pro ", " para o "),
    (" pra ", " para a "),
    ("mensagem pronto", "mensagem automatica"),
    (" mail", " email"),
    ("markt", "market"),
    ("plase", "place"),
    ("site", "loja"),
    ("loja", "loja"),
    (" app", " loja"),
    ("empresa", "loja"),
    ("aplicativo", "loja"),
    ("informar que", "dizer que"),
    ("https www reclameaqui br", "reclame aqui"),
    ("mercadoria", "pedido"),
    ("saber do", "saber sobre"),
    ("empresa ", "loja "),
    (" ver comentarios", " ler comentarios"),
    ("produto", "pedido"),
    ("item", "pedido"),
    (" comprar ", " pedido "),
    ("mudar", "trocar"),
    ("receber", "chegar"),
    ("entregar", "recebido"),
    ("ate hoje", "ate agora"),
    ("mandar", "enviar"),
    ("obg", "obrigado"),
    ("reembolsar", "dinheiro"),
    ("ressarcimento", "dinheiro"),
    ("ruim", "mau"),
    ("mal", "mau"),
    ("nunca ter", "nao ter"),
    ("estornar", "dinheiro"),
    ("msg", "mensagem"),
    ("status", "situacao"),
    ("ser entregar", "chegar"),
    ("pior", "mau"),
    ("enviar", "mandar"),
    ("pos-vender", "atendimento"),
    ("pos vender", "atendimento"),
    ("resposta", "retorno"),
    ("responder", "retorno"),
    (" to ", " estou "),
    (" dia ", " tempo "),
    (" mes ", " tempo "),
    (" ano ", " tempo "),
    ("horrivel", "mau"),
    ("chegar", "recebido"),
    ("adorar", "amo"),
    ("cliente", "consumidor"),
    ("extraviad", "perdid"),
)

# Patterns whose matches become one space, in this order.
PT_USELESS = (
    "fazer pedido", "obrigar", "numero pedido", "pedido numero", "bom dia", "bom tarde", "bom noite", "tudo bem",
    f"(^|{NO_LETTER})(ola){NO_LETTER}",
    f"(^|{NO_LETTER})(ano){NO_LETTER}",
    f"(^|{NO_LETTER})(amar){NO_LETTER}",
    "assim", "nessa", "nesse", "horar", "ok", "okay", "loja",
)

# A sentence with one of these is rejected.
PT_BLACKLIST = ("numero pedido", "pedido numero")

# Words that keep their surface form.
PT_LEMMA_EXEMPT = ("vale", "pedido", "reclame", "nota", "desconto", "adidas", "peça", "peças")

# A sentence must hold at least one of these, anywhere.
PT_MANDATORY = (
    "pedido", "loja", "chegar", "comprar", "tempo", "nunca", "hoje", "numero", "pedir", "preco", "conseguir", "mandar",
    "recebido", "agora", "entrar", "retorno", "propaganda", "lojar", "entregar", "dinheiro", "email", "receber", "problema",
    "consumidors", "retornom", "empresa", "recolher", "comentario", "acontecer", "descasar", "suportar", "separacao", "promocao",
    "retornor", "desconto", "processar", "enviar", "resolver", "responder", "trocar", "contato", "postagem", "cliente",
    "entregue", "esperar", "atendimento", "resposta", "aguardar", "reclamacao", "reputacao", "devolver", "prazo", "retornar",
    "ligar", "mau", "telefonar", "transportador", "codigo", "vale", "dm", "favor", "cancelar", "consumidor", "direct",
    "rastrear", "devolucao", "respeitar", "procon", "mensagem", "solicitar", "informar", "absurdo", "constar", "golpe",
    "enderecar", "esclarec", "atrasar", "descaso", "ajudar", "protocolo", "estocar", "cartao", "ninguem", "pagamento",
    "informacao", "demorar", "atender", "reclamar", "acabar", "cade", "decepcionar", "reclame", "fretar", "falir", "coletar",
    "correio", "clonar", "whatsapp", "perfil", "direito", "solucao", "situacao", "erro", "sac", "rapido", "aplicativo", "cupom",
    "ultima", "previsao", "roubar", "chamar", "cancelamento", "recomendar", "fiscal", "boletar", "vergonha", "medo", "ligacao",
    "decepcao", "rastreamento", "posicao", "desistir", "automatico", "processo", "parabens", "qualidade", "pos-venda", "lixo",
    "experiencia", "compromisso",
)

# End of fixed values ----------------------------------------------------------------------------

# A small starter dictionary of ours; real runs bring a full one (see `lemmatise_by_join`).
PT_LEMMAS = (
    Lemma("esperando", "VERB", "esperar"),
    Lemma("dias", "NOUN", "dia"),
    Lemma("encomenda", "NOUN", "encomendar"),
    Lemma("mandava", "VERB", "mandar"),
    Lemma("obrigado", "VERB", "obrigar"),
    Lemma("lindo", "ADJ", "lindar"),
    Lemma("vestido", "NOUN", "vestir"),
    Lemma("filha", "NOUN", "filho"),
    Lemma("comprei", "VERB", "comprar"),
    Lemma("chegou", "VERB", "chegar"),
    Lemma("recebi", "VERB", "receber"),
    Lemma("pedidos", "NOUN", "pedido"),
    Lemma("produtos", "NOUN", "produto"),
    Lemma("entregaram", "VERB", "entregar"),
    Lemma("devolvem", "VERB", "devolver"),
    Lemma("reclamando", "VERB", "reclamar"),
    Lemma("ligações", "NOUN", "ligação"),
    Lemma("boa", "ADJ", "bom"),
    Lemma("boas", "ADJ", "bom"),
)

PT = LanguageProfile(
    name="pt",
    brand="loja",
    stop_language="portuguese",
    keep_words=PT_KEEP_WORDS,
    extra_stop_words=PT_EXTRA_STOP_WORDS,
    synonyms=PT_SYNONYMS,
    mandatory=PT_MANDATORY,
    blacklist=PT_BLACKLIST,
    useless=PT_USELESS,
    lemma_exempt=PT_LEMMA_EXEMPT,
    lemmas=PT_LEMMAS,
    stem_rules=read_rules(PORTUGUESE),
)


@dataclass(frozen=True)
class Taxonomy:
    """Labels, how they are found, and what they stand for. Order counts where noted.

    ``terms``: label to its bigrams, in label order; others than the shipped ones come in with ``with_terms``, from JSON by
    `recado.sources.lookup.read_taxonomy_terms`. ``sentiments``: sentiment to labels.
    ``problems``: problem to labels, in problem order. ``severity``: least to most important.
    """

    terms: tuple[tuple[str, tuple[str, ...]], ...] = ()
    sentiments: tuple[tuple[str, tuple[str, ...]], ...] = ()
    problems: tuple[tuple[str, tuple[str, ...]], ...] = ()
    unknown_label: str = "Cluster não identificado"
    unknown_sentiment: str = "Não identificado"
    severity: tuple[str, ...] = ("Não identificado", "Outro", "Positivo", "Negativo")

    def with_terms(self, terms: Sequence[tuple[str, Sequence[str]]]) -> Taxonomy:
        return replace(self, terms=tuple((label, tuple(bigrams)) for label, bigrams in terms))

    def label_terms(self) -> list[tuple[str, int, str]]:
        return [(label, i, t) for i, (label, bigrams) in enumerate(self.terms) for t in bigrams]

    def label_sentiments(self) -> list[tuple[str, str]]:
        pairs = [(label, s) for s, labels in self.sentiments for label in labels]
        return list(dict.fromkeys([*pairs, (self.unknown_label, self.unknown_sentiment)]))

    def problem_labels(self) -> list[tuple[str, int, str]]:
        return [(p, i, label) for i, (p, labels) in enumerate(self.problems) for label in labels]


# Bigrams of each label, sentiment of each label, problem of each label ------------

# Stems; a cluster gets the first label that one of its most frequent bigrams belongs to.
PT_TERMS = (
    ("Amei comprar", ("am compr", "sup rap", "sup recomend", "ador compr", "gost compr")),
    ("Cluster não identificado", (
        "que compr", "compr loj", "entreg temp", "numer telefon", "loj loj", "que nao", "ped que", "ped ped",
        "dinh dessmand mens", "entr contat", "dess loj", "cheg hoj", "prec bom", "mau qual", "bom qual", "melhor loj",
        "problem loj", "mais temp", "present temp", "dinh dess", "vou compr", "nao numer", "compr tenil", "vou ped", "ped tenil",
        "receb temp", "compr temp", "temp dia", "mand ped",
    )),
    ("Endereço incorreto", ("enderec entreg", "enderec err", "alter enderec", "coloc enderec", "enderec antig")),
    ("Estou tendo uma experiência ruim", ("mau experienc", "mau serv")),
    ("Estou tendo um problema", ("pass problem", "sempr problem", "problem atr", "nao consegu", "problem que", "problem receb")),
    ("Estou tendo o mesmo problema que outra pessoa", ("mesm situaca", "acontec comig", "mesm cois")),
    ("Estou irritado/decepcionado", (
        "est acontec", "ach que", "que absurd", "que decepca", "que vergonh", "extrem decepc", "sup decepc", "complet decepc",
        "to decepc", "sent roub", "propagand engan", "dor cabec", "tom vergonh", "total decepc", "respe consum", "descas consum",
        "falt respe", "absurd descas", "verd absurd", "decepca total", "mau atend", "atend mau",
    )),
    ("Estou esperando retorno da empresa", ("esper retorn", "esper que")),
    ("Meu problema foi resolvido", ("foi resolv",)),
    ("Muita demora", (
        "cheg temp", "demor receb", "praz cheg", "praz receb", "esper ped", "mais me", "ate hoj", "hoj nao", "hoj nad",
        "demor entreg", "dia util",
    )),
    ("Não compro mais", ("nunc mais", "prim ult", "vez que")),
    ("Não recomendo a loja", ("nao ped", "nao recomend", "recomend ning", "par ning", "compr nad", "compr nao", "nao compr")),
    ("Não resolvem meu problema", ("sempr mesm", "nao resolv", "pod resolv", "numer protocol", "abr protocol")),
    ("Não tenho do que reclamar", ("que reclam",)),
    ("Ninguém me responde", (
        "dar retorn", "tent contat", "mand mens", "atend consum", "canal atend", "nao funcion", "nenhum retorn", "pod retorn",
        "sem retorn", "pod atend", "tent lig", "nao atend", "lix atend", "pess atend", "algum retorn", "cad retorn",
        "precis retorn", "quer retorn", "fic aguard", "mand email", "lig ning", "respond direct", "ning at", "mand direct",
        "nao retorn", "ning retorn", "nao retornom", "telefon nao",
    )),
    ("Nunca tive problemas com a loja", (
        "sempr ped", "tud cert", "cheg ant", "sempr cheg", "sempr compr", "nao ter", "ter problem",
    )),
    ("Status do pedido está incorreto", ("foi receb", "const com", "const receb")),
    ("Pedido chegou incorreto", ("ped vir", "total difer", "ped err")),
    ("Pedido não chegou", (
        "ate agor", "previsa entreg", "nao receb", "praz entreg", "cad ped", "nao cheg", "nao entreg", "quer ped", "precis ped",
        "desd temp",
    )),
    ("Onde fica a loja física?", ("fic loj",)),
    ("Tentativa de golpe", ("perfil fals", "clon whatsapp", "cuid golp", "dar golp", "ped numer")),
    ("Preciso da nota fiscal", ("not fiscal",)),
    ("Preciso de ajuda", ("com faz", "direct favor", "ajud favor", "ajud resolv", "faz par", "precis ajud", "ped favor")),
    ("Preciso do código de rastreio", ("codig rastr",)),
    ("Preciso do código de postagem", ("codig post",)),
    ("Problema com o pagamento", ("pag bolet", "carta credit")),
    ("Problema com o valor do frete", (
        "val fret", "fret gratil", "pag fret", "fret mais", "fret car", "fret absurd", "dinh fret", "fret ta",
    )),
    ("Problema com a troca", ("nao val", "val troc", "solic troc", "troc ped", "faz troc")),
    ("Problema na entrega", ("foi cheg", "separaca estoc", "que transport", "diz que")),
    ("Problema com a devolução", ("devoluca ped",)),
    ("Desconfio da promoção", ("prec que", "propagand eng")),
    ("Recebi o pedido", ("receb hoj", "ant praz")),
    ("Quero cancelar o pedido", ("cancel ped",)),
    ("Quero cupom de desconto", ("cupom descont",)),
    ("Quero o dinheiro de volta", ("devolv dinh", "dinh volt", "quer dinh", "cad dinh", "sem dinh")),
    ("Quero saber sobre meu pedido", ("gost sab", "quer sab", "sobr ped", "ped est")),
    ("Spam", ("http www", "http s")),
    ("Tenho receio de comprar", (
        "ia compr", "tant reclamaca", "comentari nega", "obrig dic", "algu compr", "quant reclamaca", "ler comentari",
    )),
    ("Vou tomar providência", (
        "procur direit", "direit consum", "ter que", "reclam aqu", "acion procon", "consum gov", "gov br", "procon sp",
        "abr reclamaca", "reclamaca procon",
    )),
)

PT_SENTIMENTS = (
    ("Positivo", (
        "Nunca tive problemas com a loja", "Recebi o pedido", "Amei comprar", "Meu problema foi resolvido",
        "Não tenho do que reclamar",
    )),
    ("Negativo", (
        "Estou irritado/decepcionado", "Muita demora", "Quero o dinheiro de volta", "Não compro mais",
        "Estou tendo uma experiência ruim", "Tenho receio de comprar", "Vou tomar providência",
        "Não recomendo a loja", "Estou tendo um problema", "Estou tendo o mesmo problema que outra pessoa",
        "Não resolvem meu problema", "Ninguém me responde", "Estou esperando retorno da empresa",
        "Desconfio da promoção", "Endereço incorreto", "Pedido não chegou", "Problema na entrega",
        "Pedido chegou incorreto", "Preciso da nota fiscal", "Preciso de ajuda", "Preciso do código de rastreio",
        "Preciso do código de postagem", "Problema com a troca", "Problema com o valor do frete",
        "Problema com o pagamento", "Problema com a devolução", "Quero cancelar o pedido",
        "Quero saber sobre meu pedido", "Status do pedido está incorreto", "Tentativa de golpe",
    )),
    ("Outro", ("Quero cupom de desconto", "Onde fica a loja física?", "Spam")),
)

PT_PROBLEMS = (
    ("Entrega não efetuada", ("Quero saber sobre meu pedido", "Pedido não chegou", "Problema na entrega",
                              "Status do pedido está incorreto")),
    ("Entrega efetuada, porém incorreta", ("Pedido chegou incorreto",)),
    ("Cancelamento", ("Quero cancelar o pedido",)),
    ("Devolução", ("Problema com a devolução",)),
    ("Pagamento", ("Problema com o pagamento",)),
    ("Preço do frete", ("Problema com o valor do frete",)),
    ("Código de rastreio", ("Preciso do código de rastreio",)),
    ("Código de postagem", ("Preciso do código de postagem",)),
    ("Nota fiscal", ("Preciso da nota fiscal",)),
    ("Tentativa de golpe", ("Tentativa de golpe",)),
    ("Endereço", ("Endereço incorreto",)),
    ("Outros problemas", ("Preciso de ajuda",)),
    ("Troca", ("Problema com a troca",)),
)

# End of fixed values ----------------------------------------------------------------------------

PT_TAXONOMY = Taxonomy(terms=PT_TERMS, sentiments=PT_SENTIMENTS, problems=PT_PROBLEMS)
