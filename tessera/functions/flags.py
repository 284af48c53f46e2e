"""Rule classifiers: lexicons of patterns, and a decision table over which of them a text meets."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the mixed flag.
MIXED_POSITIVE = (
    r"\bmliha?\b", r"\bmzian[ae]?\b", r"\bzwin[ae]?\b", r"\bhil[ae]\b", r"\btamam\b", r"\bsari3\b", r"\bbien\b", r"\bbon(ne)?\b", r"\bsuper\b", r"\bpas\s*mal\b",
    r"\bcorrect(e)?\b", r"\brapide\b", r"\befficace\b", r"مليح[ةه]?", r"زوين[ةه]?", r"\bتمام\b", r"ممتاز[ةه]?", r"سريع[ةه]?", r"جيد[ةه]?", r"حسن[ةه]?",
    r"مقبول[ةه]?", r"هايل[ةه]?", r"رائع[ةه]?", r"مزيان[ةه]?", r"معقول[ةه]?", r"كويس[ةه]?", r"راضي[ةه]?",
)
MIXED_NEGATIVE = (
    r"\bnul\b", r"\bkhaybe?\b", r"\bkhayba?\b", r"\bmachi\s*barka\b", r"\bkarica\b", r"\bkhartha?\b", r"كارثة", r"كارثه", r"كارثي[هة]?", r"فضيحة", r"مهزلة",
    r"\bzero\b", r"تحت\s*الصفر", r"لا\s*يعمل", r"ما\s*يخدم", r"مايخدمش", r"مقطوع[هة]?", r"قطوع\b", r"coupure\b", r"انقطاع\b", r"مشكل[ةه]?", r"مشاكل\b",
    r"trop\s*(lent|cher|mauvais)", r"ne\s*fonctionne\s*pas", r"marche\s*pas", r"تعبتونا", r"هرمنا", r"هبلتونا", r"وعود\s*كاذبة", r"مافيا\b", r"فساد\b",
    r"honte\b", r"catastroph\w+", r"الأسوأ\b", r"الاسوى\b", r"ضعيف[ةه]?", r"بطيء\b", r"بطيئ[ةه]?\b", r"غالي[ةه]?", r"cher\b", r"prix\s*(élevé|excessif|astronomique)",
)
# Patterns of the encouragement flag.
ENCOURAGEMENT = (
    r"bon\s*courage", r"bonne?\s*continuation", r"bonne?\s*chance", r"f[eé]licitations?", r"bravo\b", r"chapeau\b", r"all\s*the\s*best", r"bonne?\s*r[eé]ussite", r"mention\b",
    r"meilleurs?\s*v[oœ]ux", r"tous\s*mes\s*v[oœ]ux", r"bon\s*succ[eè]s", r"succ[eè]s\s*continu", r"joyeuses?\s*f[eê]tes?", r"bonne?\s*f[eê]te", r"joyeux\s*ramadan",
    r"toujours\s*plus\s*(loin|haut|fort|proche|innovant)", r"keep\s*it\s*up", r"well\s*done", r"good\s*luck", r"barra\s*barra", r"[ae]ychine?\b", r"3aychine?\b",
    r"nchallah\s*ynajh", r"inch[a]?allah\s*ynajh", r"mabrouk\b", r"mbr[ou]+k\b", r"rbi\s*y[3e]awkom", r"allah\s*yewfek", r"allah\s*yewfeqkom", r"tbarakallah\b", r"tbarkallah\b",
    r"saha\s*[ae]idkom", r"sa7a\s*[ae]idkom", r"kol\s*[3e]am\s*w", r"[ae]id\s*mobarak", r"barak\s*allah", r"allah\s*ybarek",
    r"بالتوفيق", r"بتوفيق", r"ألف\s*مبروك", r"مبروك\b", r"ماشاء\s*الله", r"ما\s*شاء\s*الله", r"تبارك\s*الله", r"بارك\s*الله\s*فيكم", r"بارك\s*الله\s*فيك", r"ربي\s*يوفق", r"ربي\s*يوفقكم",
    r"الله\s*يوفق", r"الله\s*يبارك", r"نتمنى\s*(لكم|لك)\s*(النجاح|التوفيق|التألق|الاستمرار)", r"كل\s*عام\s*و[أا]نتم\s*بخير", r"سنة\s*(جديدة|مليئة)", r"عام\s*(جديد|مبارك)", r"إلى\s*الأمام",
    r"دائما\s*(في\s*تقدم|أقرب|إلى\s*الأمام)", r"المزيد\s*من\s*(النجاح|التألق|الإنجازات)", r"مزيد\s*من\s*(التألق|النجاح|التطور)", r"خطوة\s*هايلة", r"في\s*القمة", r"برافو\b", r"حاجة\s*مليحة",
)
ENCOURAGEMENT_NEGATIVE = (
    r"réclamation", r"plainte", r"problème", r"panne", r"non\s*activé", r"ne\s*fonctionne\s*pas", r"marche\s*pas", r"débit\s*(lent|faible|catastrophique)", r"connexion\s*lente", r"coupure",
    r"depuis\s*\d+\s*(jours?|mois|semaines?)", r"sans\s*réponse", r"nul\b", r"inexistant", r"catastrophe", r"honte", r"شكوى", r"شكاية", r"شكاوي", r"مشكل", r"مشكلة", r"لا\s*يعمل", r"مقطوع", r"قطوع", r"بطيء", r"ضعيف",
    r"ما\s*خدم", r"مكانش", r"ما\s*ركبوا", r"ما\s*تواصل", r"ما\s*جاو", r"ما\s*حلوا", r"ما\s*صلحوا", r"ما\s*ردوا", r"\d+\s*(أشهر|يوم|سنة).*(?:انتظار|دون|بدون)", r"معاناة", r"اذلال", r"تعبتونا", r"هبلونا",
    r"وعود\s*كاذبة", r"بدون\s*حل", r"دون\s*أي\s*حل", r"فساد", r"مافيا", r"سجن", r"ديكتاتور", r"mochkil", r"ma\s*khedmetch", r"makach", r"hchouma", r"ta3batna", r"hablona",
    r"tzido.{0,20}(batel|tgt3|mochkil)", r"zidou.{0,20}(batel|tgt3|mochkil)", r"عام\s*(جديد|سعيد).{0,60}(خيوط|انقطاع|نحاس|adsl|مشكل|عيب)", r"(خيوط|انقطاع|نحاس|adsl|مشكل|عيب).{0,60}عام\s*(جديد|سعيد)",
)
OFF_TOPIC = (
    r"\busmk\b", r"\busm\s*khenchela\b", r"\bcrb\b", r"\bmca\b", r"\busma\b", r"\bmc\s*alger\b", r"فريق\s+(?!اتصالات)", r"لفريق\s+\w+(?<!اتصالات)", r"على\s*حساب\s*اموال\s*الشعب",
    r"ديكتاتور", r"تبون", r"بوتفليقة", r"يونيسكو", r"بلغاريا", r"تراث.*ثقافي", r"عصور\s*وثنية", r"قبل\s*التاريخ",
)
PRODUCT = (
    r"appli(cation)?\b", r"service\b", r"réseau\b", r"connexion\b", r"débit\b", r"fibre?\b", r"internet\b", r"offre\b", r"abonnement\b", r"prix\b", r"tarif\b", r"vitesse\b", r"signal\b", r"4g\b", r"5g\b", r"wifi\b",
    r"box\b", r"modem\b", r"l['’]appli", r"le\s*service", r"le\s*réseau", r"la\s*connexion", r"gpon\b", r"xgs.?pon\b", r"fttx\b", r"adsl\b", r"vdsl\b", r"idoom\b", r"الانترنت", r"انترنت\b", r"الشبكة", r"شبكة\b",
    r"الفيبر", r"فيبر\b", r"الاشتراك", r"الخدمة", r"السعر", r"التدفق", r"الاتصال", r"المودم", r"مودم\b", r"الباقة", r"الالياف\s*البصرية", r"الياف\b", r"تطبيق", r"الاندرويد", r"التطبيق",
)
# Patterns of the negation flag.
NEGATION = (
    r"\bmachi\b", r"\bmachi\s+\w+", r"\bwalo\b", r"\bvalou\b", r"\bwalou\b", r"\bma\s*[\w]+sh\b", r"\bma\s*[\w]+ch\b", r"\bma\s*[\w]+ش\b", r"\bماجازش\b", r"\bماسمعناش\b", r"\bماخدمتوش\b", r"\bما\s*نقدرش\b", r"\bمايمشيش\b",
    r"\bومنقدرش\b", r"\bماشراهش\b", r"\bمحبوش\b", r"\bمحبوهش\b", r"\bمابغاوش\b", r"\bمابغيتش\b", r"\bوالو\b", r"\bولا والو\b", r"\bماكان والو\b", r"\bماكان حتى حاجة\b", r"\bماكان حتى فايدة\b",
    r"\bما\s*(هو|هي|هم|هن|كان|كانت|يكون|كانوا)\b", r"\bلا\s+\w+", r"\bلم\s+\w+", r"\bلن\s+\w+", r"\bليس\b", r"\bليست\b", r"\bليسا\b", r"\bليسوا\b", r"\bغير\s+\w+", r"\bبدون\b", r"\bدون\b", r"\bمكانش\b", r"\bماكاش\b", r"\bماكانتش\b",
    r"\bما\s*kach\b", r"\bمافيش\b", r"\bمافيهاش\b", r"\bمافيهوش\b", r"\bماعندوش\b", r"\bماعندهاش\b", r"\bماعندناش\b", r"\bمازال\s*ما\b", r"\bحتى الآن ما\b", r"\bمش\b", r"\bميش\b", r"\bماشي\b", r"\bمانيش\b", r"\bمارناش\b",
    r"\bne\s+\w+\s+pas\b", r"\bne\s+\w+\s+plus\b", r"\bne\s+\w+\s+jamais\b", r"\bne\s+\w+\s+rien\b", r"\bn['']y\s+a\s+pas\b", r"\bpas\s+de\b", r"\baucun(e)?\b", r"\bjamais\b", r"\bplus\s+de\b", r"\brien\b", r"\bpersonne\b", r"\bnulle\s+part\b",
    r"\bمازال ما جوش\b", r"\bمازال ما ركبوش\b", r"\bولم يأتي\b", r"\bولم يتم\b", r"\bحتى الساع[هة]\b", r"\bرغم مرور\b", r"\bطولتو(بزاف)?\b", r"\btoujours rien\b",
)
NEGATION_POSITIVE = (
    r"\bmliha?\b", r"\bmlih[ةه]?\b", r"\bmzian[ae]?\b", r"\bzwin[ae]?\b", r"\bzween[ae]?\b", r"\btamam\b", r"\btop\b", r"\bnice\b", r"\bbien\b", r"\bbon(ne)?\b", r"\bsuper\b", r"\bexcellent\b", r"\bparfait\b", r"\bcorrect(e)?\b",
    r"\brapide\b", r"\befficace\b", r"\bprofessionnel\b", r"\bsatisfait\b", r"\brecommande\b", r"\bnickel\b", r"مليح[ةه]?", r"ممتاز[ةه]?", r"سريع[ةه]?", r"جيد[ةه]?", r"هايل[ةه]?", r"رائع[ةه]?", r"كويس[ةه]?", r"راضي[ةه]?",
    r"ناجح[ةه]?", r"موفق[ةه]?", r"احترافي[ةه]?", r"مناسب[ةه]?", r"مضمون[ةه]?", r"ثقة\b", r"\bمنيح\b", r"\bمشكور[ين]?\b", r"\bموفقين\b",
)
NEGATION_NEGATIVE = (
    r"\bnul\b", r"\bkhaybe?\b", r"\bkhayba?\b", r"\bmauvais(e)?\b", r"\bzero\b", r"\bfaible\b", r"\blent\b", r"\bcher\b", r"\btrop\s*(lent|cher|mauvais|long)\b", r"كارث[هةي]?", r"كارثه?", r"فضيحة", r"مهزلة", r"ضعيف[ةه]?", r"بطيء", r"بطيئ[ةه]?",
    r"رديء", r"رديئة", r"خردة", r"خايب[ةه]?", r"فاشل[ين]?", r"افشل", r"مخيب", r"غالي[ةه]?", r"سرقة", r"نصب", r"احتيال", r"مشكل[ةه]?", r"مشاكل", r"عطل", r"انقطاع", r"\bmochkil\b", r"\bma\s*khedmetch\b", r"\bmakach\b", r"\bta3batna\b", r"\bhablona\b",
    r"\bqahruna\b", r"\bهرمنا\b", r"\bهرمتونا\b", r"\bهبلتونا\b", r"\bهبلتو\b", r"\bمرضتونا\b", r"\bتعبتونا\b", r"\bعييتونا\b", r"\bقهرونا\b", r"\bكرهنا\b", r"\bكرهتونا\b", r"\bمافيا\b", r"\bفساد\b", r"\bوعود\s*كاذبة\b", r"\bمتحشموش\b",
    r"\bمهابل\b", r"\bمساسيط\b", r"\bهايله\b", r"\bيكدبو\b", r"\bكذابيين\b", r"\bكدابين\b", r"\bنيك[ماكم]?\b", r"\bواش\s*نيك\b", r"\bنيكمات[كم]?\b", r"\bمايخدمش\b", r"\bما\s*يخدمش\b", r"\bلا\s*يعمل\b", r"\bمقطوع[ةه]?\b", r"\bقطوع\b", r"\bcoupure\b",
    r"\bمايصلحش\b", r"\bما\s*يصلحش\b", r"\bميمشيش\b", r"\bما\s*يمشيش\b", r"\bالأسوأ\b", r"\bالاسوى\b", r"\bأسوأ خدمة", r"\bتحت\s*الصفر\b", r"\bصفر\b", r"\b0/10\b", r"\b\d+\s*(jours?|أيام|يوم|ايام|mois|أشهر|اشهر|شهر|semaines?)\b", r"\bمنذ\s*\d+\b",
    r"\bdepuis\s*\d+\b", r"\bاكثر\s*من\s*\d+\b", r"\bمرارا\s*وتكرارا\b", r"\bsans\s*r[eé]ponse\b", r"\bبدون\s*(رد|حل)\b", r"\bدون\s*(رد|حل|جدوى)\b", r"\bلا\s*جديد\b", r"\bحتى\s*الان\s*(لا|ما|لم)\b", r"\bلحد\s*الان\s*(لا|ما|لم)\b", r"\bhonte\b", r"\bcatastroph\w+",
)
#: Composed expressions, with the type that each gives. Fixed values.
NEGATION_COMPOSED = (
    r"\bمازال\s+الانترنت\s+ما\s+جاتش\b", r"\bنهار\s+كامل\s+مكانش\b", r"\bخلصت.*?(مازال|ما\s+جا|لا\s+يوجد|لم\s+يتم|بلا)", r"\bمبعد\s+ساهل\b", r"\bامبعد\s+ساهل\b", r"\bمن بعد ساهل\b", r"\bأقرب مسافة وأبعد معاملة\b", r"\bالريح فالشباك\b",
    r"\bلا حياة لمن تنادي\b", r"\bمكان حتى خدمات.*?يكذبو علينا\b", r"\bنعيط والو\b", r"\bنروح نشكي والو\b", r"\bخلصنا في الريح\b", r"\bدفعنا و ماكان والو\b", r"\bservice\s+تحت\s+الصفر\b", r"\bpublicité mensongère\b", r"\bgaspiller mon credit\b",
    r"\bconnexion coupée depuis\b", r"\bsans internet depuis\b", r"\bكي ديرولنا لفيبر و امبعد ساهل\b", r"\bاطلقوها من بعد ساهل\b", r"\bراقب خدامات مبعد ساهل\b",
)


def any_of(patterns: tuple[str, ...]) -> str:
    """One pattern that is found wherever any of ``patterns`` is.

    Patterns are grouped by whether they begin at a word boundary and by their
    first letter, so that most places of a text are passed after one look.
    """
    groups: dict[str, dict[str, list[str]]] = {"\\b": {}, "": {}}
    for p in patterns:
        edge = "\\b" if p.startswith("\\b") else ""
        rest = p[len(edge) :]
        letter = rest[0] if rest[0].isalnum() and not re.match(r".[?*{|]", rest) and not _open_choice(rest) else ""
        groups[edge].setdefault(letter, []).append(rest[len(letter) :])
    parts = []
    for edge, by_letter in groups.items():
        free = by_letter.pop("", [])
        choices = [f"{letter}(?:{'|'.join(rest)})" for letter, rest in by_letter.items()]
        if choices:
            parts.append(f"{edge}(?=[{''.join(by_letter)}])(?:{'|'.join(choices)})")
        if free:
            parts.append(f"{edge}(?:{'|'.join(free)})")
    return "|".join(parts)


def _open_choice(pattern: str) -> bool:
    """Whether a choice stands outside all brackets of a pattern."""
    depth = 0
    for x in re.sub(r"\\.|\[[^\]]*\]", "", pattern):
        depth += (x == "(") - (x == ")")
        if x == "|" and not depth:
            return True
    return False


def meets(c: Column, patterns: tuple[str, ...], dotall: bool = False, lowered: bool = False) -> Column:
    """Whether any pattern is found, without regard to case (``lowered`` text needs none); null text meets none."""
    return F.coalesce(c.rlike(f"(?{'' if lowered else 'i'}U{'s' if dotall else 'd'}){any_of(patterns)}"), F.lit(False))


def evidence(c: Column, patterns: tuple[str, ...]) -> Column:
    """The first text that a pattern finds, null if none does."""
    return F.nullif(F.regexp_extract(c, f"(?iUd)({'|'.join(patterns)})", 1), F.lit(""))


def _flag(value: Column | int, kind: Column | str | None) -> Column:
    v = F.lit(value) if isinstance(value, int) else value
    k = F.lit(kind).cast("string") if kind is None or isinstance(kind, str) else kind
    return F.struct(v.alias("flag"), k.alias("type"))


def mixed(c: Column) -> Column:
    """(1, pos_neg) where a strong positive and a strong negative word meet, else (0, null)."""
    return F.when(meets(c, MIXED_POSITIVE) & meets(c, MIXED_NEGATIVE), _flag(1, "pos_neg")).otherwise(_flag(0, None))


def mixed_evidence(c: Column) -> Column:
    """The first expression of either kind that makes a text mixed."""
    return F.concat_ws(" ↔ ", evidence(c, MIXED_POSITIVE), evidence(c, MIXED_NEGATIVE))


def negation_evidence(c: Column) -> Column:
    t = F.lower(c)
    return F.concat_ws(" ⊗ ", evidence(t, NEGATION), evidence(t, NEGATION_POSITIVE))


def complaint_evidence(c: Column) -> Column:
    return F.concat_ws(" | ", evidence(c, CONTACT), evidence(c, FRUSTRATION))


def encouragement(c: Column) -> Column:
    """Good wishes: cancelled by a complaint or an alien topic, else with or without a product."""
    none = _flag(0, None)
    return (
        F.when(~meets(c, ENCOURAGEMENT), none)
        .when(meets(c, ENCOURAGEMENT_NEGATIVE, dotall=True), _flag(0, "negatif"))
        .when(meets(c, OFF_TOPIC), _flag(0, "offtopic"))
        .when(meets(c, PRODUCT), _flag(1, "produit"))
        .otherwise(_flag(1, "pur"))
    )


def negation(c: Column) -> Column:
    """Composed expressions first, by the words that the expression itself holds; then negation with a positive or a negative word, or alone."""
    t = F.lower(F.coalesce(c, F.lit("")))
    composed = None
    for p in NEGATION_COMPOSED:
        source = F.lit(p)  # the expression's own text decides its type
        kind = F.when(meets(source, NEGATION_POSITIVE), "neg_pos").when(meets(source, NEGATION_NEGATIVE), "neg_neg").otherwise("neg_seule")
        composed = (F if composed is None else composed).when(meets(t, (p,), lowered=True), _flag(1, kind))
    pos, neg = (meets(t, words, lowered=True) for words in (NEGATION_POSITIVE, NEGATION_NEGATIVE))
    kind = F.when(pos & ~neg, "neg_pos").when(neg & ~pos, "neg_neg").otherwise("neg_seule")
    plain = F.when(meets(t, NEGATION, lowered=True), _flag(1, kind)).otherwise(_flag(0, None))
    return F.when(meets(t, NEGATION_COMPOSED, lowered=True), composed).otherwise(plain)


# Patterns of the social flag.
SOCIAL = (
    r"بارك\s*الله", r"الله\s*يبارك", r"الله\s*يعاون", r"ربي\s*يعاون", r"ربي\s*يجازي", r"جزاك\s*الله\s*خير", r"جزاكم\s*الله\s*خير", r"الله\s*يوفق", r"ربي\s*يحفظ", r"ربي\s*يوفق", r"بالتوفيق", r"رمضان\s*كريم", r"رمضان\s*مبارك", r"عيد\s*مبارك", r"عيد\s*سعيد",
    r"كل\s*عام\s*و[أا]نتم", r"كل\s*عام\s*وأنتم", r"مبروك", r"تبارك\s*الله", r"ماشاء\s*الله", r"ما\s*شاء\s*الله", r"الله\s*معاكم", r"الله\s*معاك\b", r"ربي\s*يوفقكم", r"ربي\s*يوفقك\b", r"الله\s*يوفقكم", r"شكرا\s*على\s*جهودكم", r"شكرا\s*على\s*المجهودات",
    r"ربي\s*يجازيكم", r"ربي\s*يعاونكم", r"إن\s*شاء\s*الله\s*ينجح", r"نشالله\s*ينجح", r"يسلموا?\b", r"الله\s*يسلمك", r"صح\s*فطورك", r"صح\s*فطوركم", r"صح\s*عيدك", r"صح\s*عيدكم", r"حفظكم\s*الله", r"وفقكم\s*الله", r"الله\s*يعطيكم\s*الصحة", r"ربي\s*يبارك\s*فيكم", r"ربي\s*يبارك\s*فيك\b",
    r"rbi\s*y[3e]awkom", r"rabi\s*y[3e]awkom", r"barak\s*allah", r"baraka\s*llah", r"allah\s*ybarek", r"allah\s*yewfek", r"allah\s*yewfeqkom", r"tbarakallah", r"tbarkallah", r"nchallah\s*ynajh", r"inch[a]?allah\s*ynajh", r"saha\s*ftourkoum", r"saha\s*[ae]idkom", r"sa7a\s*[ae]idkom",
    r"kol\s*[3e]am\s*w", r"[ae]id\s*mobarak", r"[ae]id\s*sa[3i]id", r"mabrouk", r"mbr[ou]+k", r"bon\s*courage", r"bonne?\s*continuation", r"merci\s*pour\s*vos\s*efforts", r"merci\s*pour\s*le\s*travail", r"courage\s*[àa]\s*tou[st]", r"bonne?\s*ann[eé]e", r"assegwas\s*amegas",
    r"vive\s*alg[eé]rie", r"allah\s*ma[3e]akom", r"rabi\s*ma[3e]akom", r"barra\s*barra\s*likom", r"[ae]ychine\b", r"3aychine\b", r"rbi\s*yjazik", r"yeslamo\b", r"ya3tikom\s*essa7a", r"joyeux\s*ramadan", r"bon\s*travail", r"bravo\s*(à\s*)?l[a-z]*\s*[eé]quipe", r"bonne?\s*f[eê]te",
    r"f[eé]licitations?", r"bonne?\s*chance", r"bravo\s*pour", r"chapeau\s*pour", r"joyeuses?\s*f[eê]tes?", r"meilleurs?\s*v[oœ]eux", r"bonne?\s*journ[eé]e", r"bon\s*succ[eè]s", r"bonne?\s*r[eé]ussite", r"tous\s*mes\s*v[oœ]eux",
)
SOCIAL_NEGATIVE = (
    r"مشكل", r"مشكلة", r"شكاية", r"شكوى", r"شكاوي", r"ما\s*خدم", r"مكانش", r"ما\s*عندي", r"ما\s*ركبوا", r"ما\s*تواصل", r"ما\s*جاو", r"ما\s*حلوا", r"ما\s*صلحوا", r"ما\s*ردوا", r"مشكل.*جزاك", r"انتظار", r"أنتظر", r"نستنى", r"وعود\s*كاذبة", r"سوء\s*الاستقبال",
    r"بدون\s*حل", r"دون\s*[أا]ي\s*حل", r"هل\s*يعقل", r"هل\s*منطق", r"نقطة\s*الصفر", r"معاناة", r"اضطهاد", r"ظلم", r"إرهاب", r"مافيا", r"فساد", r"سجن", r"ديكتاتور", r"تبون", r"بوتفليقة", r"فاضح", r"راكم\s*غير\s*تزيدوا\s*تبعدوا", r"خدمة.*شهر", r"شهر.*ما.*ركب", r"شهرين.*ولحد",
    r"ست\s*اشهر", r"شهر\s*ونص", r"يحرم\s*من\s*خدمة", r"لم\s*يتواصلوا", r"لم\s*نستطع", r"لم\s*يرد", r"خط\s*أخضر.*لا\s*يرد", r"تعبتونا", r"هبلونا", r"حيكم", r"اذلال",
)
# Patterns of the complaint flag.
CONTACT = (
    r"ردو?\s*(في\s*|على\s*|فال|فل|ف)?\s*[ال]?خاص\b", r"ر[دج]وا?\s*(في\s*)?الخاص", r"الرد\s*(في|على)\s*الخاص", r"نرجو\s*الرد\s*(في|على)?\s*الخاص", r"ارجو\s*(منكم\s*)?الرد\s*(في|على)\s*الخاص", r"الرجاء\s*الرد\s*(في|على|على)?\s*الخاص", r"يرجى\s*الرد\s*(على|في)\s*الخاص", r"رجاء\s*الرد\s*(على|في)\s*الخاص",
    r"ردو\s*عليا\b", r"ردو\s*علينا\b", r"ردو\s*على\s*(الرسائل|الرسا[يئ]ل|الميساجات|ميساجات|لميساج|انشغالي|الخاص|خاص|رسائل)", r"رد\s*(في|على)\s*الخاص", r"ردو\s*(الخاص|في\s*الخاص)\b", r"بعثتلكم?\s*(في|على|فال|فل)?\s*الخاص", r"بعثلكم\s*الخاص", r"بعثتلك\s*(في|على)\s*الخاص",
    r"ارسلتك?\s*(على|في|لكم)\s*(رساله|رسالة|في)?\s*الخاص", r"ارسلت\s*لكم\s*رساله\b", r"راسلنا\s*(عبر|في|على|مرارا)", r"راسلتكم\b", r"لا\s*(يوجد|يتم)\s*رد\b", r"لايوجد\s*رد\b", r"لا\s*تردون\b", r"لا\s*تردو\b", r"لا\s*يردون\b", r"لا\s*يردو\b", r"لاتحيبون\b", r"لا\s*تحيبون\b", r"لا\s*تقومون\s*بالرد",
    r"لم\s*يتم\s*(الرد|رد)\b", r"لا\s*يتم\s*(الرد|رد)\b", r"لماذا\s*لا\s*تردو", r"لماذا\s*لاتردون", r"لماذا\s*لا\s*يتم\s*الرد", r"اصبحتم\s*لا\s*تردون", r"لا\s*يردون\s*على\s*الزبائن", r"مكمش\s*تردو", r"ماكمش\s*تردو", r"مراكمش\s*تردو", r"مكانش?\s*رد\b", r"متردوش\b", r"لم\s*يرد\s*(احد|عليا|علي)\b", r"ولا\s*رد\b", r"مايريبونديوش\b",
    r"خاصيه\s*الرد.*غير\s*موجوده", r"ياو\s*ردو", r"ياو\s*الرد", r"اخي\s*ردو", r"معليش\s*تردو", r"تواصلو?\s*(معنا|معي|مع[يا]|معاك)\b", r"تواصل\s*معي\b", r"اتصلو\s*بي\b", r"خطي\s*غير\s*موهل\b", r"\bprv\b", r"\binbox\b", r"repondi[w]?\s*prv", r"jawbouna\b", r"r[eé]pondez?\s*(nous|moi)",
    r"contactez[\s\-]?(nous|moi)", r"contactez\s*moi\b", r"envoyez?\s*(nous|moi)\s*(un\s*)?message", r"send\s*(us|me)\s*(a\s*)?dm", r"\bdm\s*(us|me|nous)?\b",
)
FRUSTRATION = (
    r"\d+\s*(jours?|أيام|يوم|ايام|mois|أشهر|اشهر|شهر|semaines?|سمانه|ساعات|ساعه)", r"منذ\s*\d+", r"depuis\s*\d+", r"اكثر\s*من\s*\d+\s*(اشهر|اسابيع|ايام|شهر|يوم)", r"مرارا\s*وتكرارا", r"sans\s*r[eé]ponse", r"بدون\s*(رد|حل)", r"دون\s*(رد|حل|جدوى)", r"دون\s*جدوى\b", r"لا\s*جديد\s*يذكر", r"حتى\s*الان\s*(لا|ما|لم)", r"لحد\s*الان\s*(لا|ما|لم)",
    r"انشغال\w*", r"شكو[ىا]\b", r"شكايه\b", r"شكوه\b", r"probl[eè]me?\b", r"مشكل[ةه]?\b", r"مشاكل\b", r"عطل\b", r"مستعجل\b", r"مهم\s*ومستعجل", r"انتظار\b", r"attente\b", r"ننتظر\b", r"نستنى\b", r"انتظر\s*(الرد|ردكم)", r"لا\s*يعمل\b", r"لا\s*يشتغل\b", r"لا\s*يتصل\s*بالانترنت", r"ne\s*fonctionne\s*pas", r"marche\s*pas", r"ما\s*خدم\b", r"مايخدم\b", r"مايصلح\b",
    r"coupure\b", r"انقطاع\b", r"مقطوع[هة]?\b", r"موقف\b", r"suspendu\b", r"لم\s*يتم\s*تفعيل", r"لا\s*يتم\s*تفعيل", r"لم\s*يتواصل\b", r"لم\s*يات\b", r"تدفق\s*(كارثي|ضعيف)", r"بلا\s*انترنت", r"مكانش\s*انترنت", r"الانترنت\s*مكانش", r"الانترنت\s*مقطوع", r"مقطوعه\s*عندها", r"مازال\s*الانترنت\s*ما\s*جاتش", r"نهار\s*كامل\s*مكانش", r"بدون\s*الانترنت", r"لا\s*توجد\s*انترنت", r"نحتاج\s*انترنت",
    r"\bnul\b", r"catastrophe?\b", r"كارثه?\b", r"كارثة\b", r"كارثيه\b", r"honte\b", r"عيب\b", r"inacceptable\b", r"danger\s*national", r"خدمات?\s*(تحت\s*الصفر|صفر)", r"تحت\s*الصفر\b", r"صفر\s*كبير?\b", r"الاسوى\b", r"الأسوأ\b", r"دائما\s*الاسوى", r"مستوى\s*ناقص", r"سوء\s*استغلال", r"عدم\s*الالتفات", r"عدم\s*حل", r"تعبتونا\b", r"هرمنا\b", r"هبلتونا\b", r"تهبلونا\b", r"قهرونا\b", r"مرضتونا\b",
    r"عييتونا\b", r"كرهنا\b", r"كرهتونا\b", r"شبعتونا\b", r"مقروط\b", r"مستفز[هة]\b", r"يكدبو\b", r"كذابيين\b", r"وعود\s*كاذبة", r"مافيا\b", r"فساد\b", r"متحشموش\b", r"مهابل\b", r"هايله\b", r"فاشلين\b", r"شركه\s*(ضخمه|في\s*انحطاط)", r"ماكمش\s*تصدقو", r"ماتهزوش\b", r"خلصت?\b.{0,50}(مازال|ما\s*جا|لا\s*يوجد|لم\s*يتم|بلا)", r"خلصت?\b.{0,10}(mo|ميغا).{0,20}(تلحق|غير)", r"مزدتوليش\b", r"شارجيت.{0,30}علاش",
    r"فواتير.{0,30}مدفوع.{0,30}(لا|ما|مازال|موقف)", r"تم\s*توقيف\s*خط", r"خط\s*مقفل\b", r"رانا\s*في\s*(ساعه|يومين|اسبوع)", r"رانا\s*نخلصو\b", r"الانترنت\s*(نهار\s*كامل|كامل)", r"قدمت\s*شكوى", r"اريد\s*تقديم\s*شكوا", r"ضد\s*الزبون", r"يعاني\b", r"معاناه\b", r"لم\s*يتم\s*الربط", r"بعيده\s*عن\s*البيوت", r"روتينق\s*(راه\s*)?كارث", r"بينق.{0,20}(كارث|مرتفع)", r"في\s*\d+\s*اشهر.{0,30}(كارث|مشكل|ضعيف)",
    r"نيك\b", r"نيكما", r"قحبة\b", r"حمار\b", r"كلب\b",
)
OFFICIAL_REPLY = (
    r"ندعوكم\s*(للتواصل|للتواصل\s*معنا)", r"يمكنكم\s*(التواصل|مراسلتنا)", r"بإمكانكم\s*التواصل", r"ابقوا\s*على\s*تواصل\s*معنا", r"سيتم\s*(اعلامكم|إعلامكم|التواصل)", r"نعمل\s*باستمرار\s*على\s*(تطوير|تحسين)", r"لتمكننا\s*من\s*تقديم\s*المساعده", r"قصد\s*تزويدنا\s*بمعلومات", r"لنتمكن\s*من\s*تقديم\s*المساعده",
    r"لقد\s*تم\s*التواصل\s*معك\s*في\s*الخاص", r"اذا\s*كنتم\s*تواجهون\s*اي\s*خلل", r"فبامكانكم\s*التواصل\s*معنا\s*عبر\s*الخاص",
)
ANGER = (
    r"هرمنا\b", r"هرمتونا\b", r"هبلتونا\b", r"هبلتو\b", r"تهبلونا\b", r"مرضتونا\b", r"تعبتونا\b", r"ta3batna\b", r"قهرونا\b", r"قسونا\b", r"عييتونا\b", r"نقسوناوفسوم", r"شبعتونا\b", r"مقروط\b", r"كرهتونا\b", r"كرهنا\b", r"كارثيه\b", r"مافيا\b", r"فساد\b", r"متحشموش\b", r"الأسوأ\b", r"الاسوى\b", r"مايصلحش\b",
    r"ما\s*يصلحش\b", r"ميمشيش\b", r"ما\s*يمشيش\b", r"مكانش\s*(خدمة|رد|حل)", r"يكدبو\b", r"كذابيين\b", r"كدابين\b", r"وعود\s*كاذبة", r"مهابل\b", r"مساسيط\b", r"هايله\b", r"نيكماتكم\b", r"نيكماتك\b", r"واش\s*نيك", r"danger\s*national", r"شركه?\s*مستفز[هة]\b",
)
POLITE = (r"بالتوفيق\b", r"ربي\s*يوفقكم", r"بارك\s*الله", r"bravo\b", r"félicitations?\b", r"bon\s*courage\b", r"مبروك\b", r"ماشاء\s*الله", r"نتمنى\s*(لكم|لك)\s*(النجاح|التوفيق)", r"إلى\s*الأمام\b")
# Patterns of the suggestion flag.
SUGGESTION_POSITIVE = (
    r"\bmliha?\b", r"\bmzian[ae]?\b", r"\bzwin[ae]?\b", r"\bhil[ae]\b", r"\btamam\b", r"\bmazyan[ae]?\b", r"\bsari3\b", r"\bb[ae]rak\s*allah\b", r"\bbien\b", r"\bbon(ne)?\b", r"\bsuper\b", r"\bpas\s*mal\b", r"\bcorrect(e)?\b", r"\bsatisfais?ant(e)?\b", r"\brapide\b", r"\befficace\b", r"\bc'est\s*bien\b", r"\bça\s*march[e]?\b",
    r"\bça\s*fonctionn\w+\b", r"\bbon\s*d[ée]but\b", r"\bencourageant(e)?\b", r"\bglobalement\s*(positif|bien|correct)\b", r"\bbon\s*travail\b", r"\bp[ae]s\s*mal\b", r"\bbonne\s*(qualité|vitesse|connexion)\b", r"\bla\s*connexion\s*(est\s*)?(bonne|correcte|rapide|stable)\b", r"مليح[ةه]?", r"زوين[ةه]?", r"\bتمام\b", r"ممتاز[ةه]?",
    r"سريع[ةه]?", r"جيد[ةه]?", r"حسن[ةه]?", r"مقبول[ةه]?", r"هايل[ةه]?", r"رائع[ةه]?", r"مزيان[ةه]?", r"معقول[ةه]?", r"كويس[ةه]?", r"نظيف[ةه]?", r"مرتاح[ةه]?", r"راضي[ةه]?", r"خدمة\s*(مليحة|جيدة|حسنة|معقولة)", r"الخدمة\s*(مليحة|جيدة|ممتازة)", r"اتصال\s*(مليح|جيد|سريع)", r"الانترنت\s*(مليح|مليحة|سريع|تمام)", r"سرعة\s*(كويسة|مليحة|جيدة)",
)
CONTRAST = (
    r"\bms\b", r"\bbss\b", r"\blukan\b", r"\blou?kan\b", r"\bwalakin\b", r"\bmais\b", r"\bcependant\b", r"\btoutefois\b", r"\bseulement\b", r"\bpar\s*contre\b", r"\bn[eé]anmoins\b", r"\bsi\s*possible\b", r"\bsi\s*seulement\b", r"\bsauf\s*que\b", r"\bexcept[eé]\s*que\b", r"\bà\s*condition\s*que\b", r"\bبصح\b", r"\bلكن\b",
    r"\bوالكن\b", r"\bغير\s*أن\b", r"\bإلا\s*أن\b", r"\bبس\b", r"\bلو\s*كان\b", r"لو\s*كانو", r"\bفقط\s*لو\b", r"\bولكن\b", r"\bمع\s*ذلك\b", r"\bرغم\s*ذلك\b", r"\bبالرغم\s*من\b",
)
IMPROVE = (
    r"\btehsen[ou]*\b", r"\btzid[ou]*\b", r"\bbeddl[ou]*\b", r"\bcorrigi\b", r"\bdebugi\b", r"\brajou[ou]*\b", r"\bml[ou]+\b", r"\bkamml[ou]*\b", r"\bhasn[ou]*\b", r"amélior\w+", r"optim[iu]s\w+", r"augment\w+\s*(la\s*|le\s*)?(vitesse|débit|qualité)", r"r[eé]duir\w+\s*(le\s*|les\s*)?prix", r"baiss\w+\s*(le\s*|les\s*)?prix", r"peaufin\w+", r"ajust\w+",
    r"travaill\w+\s*sur", r"des?\s*am[eé]liorations?\b", r"des?\s*efforts?\b", r"un\s*peu\s*plus\b", r"encore\s*mieux\b", r"plus\s*de\s*(rapidité|vitesse|qualité|stabilité)", r"il\s*(faut|faudrait)\s*(encore|plus)", r"il\s*(reste|y\s*a)\s*(des\s*)?am[eé]liorations?\s*[àa]\s*faire", r"ce\s*serait\s*(bien|mieux|parfait)\s*(de|si)", r"j'aimerais?\s*(plus|voir|que)",
    r"on\s*attend\s*(mieux|plus)", r"si\s*possible\s*(am[eé]lior|r[eé]duir|augment|opt)", r"تحسين", r"يتحسن", r"تحسنو", r"تزيدو", r"نتمنى\s*(يتحسن|تحسين|أكثر|أفضل)", r"يلزم\s*تحسن", r"خاصكم\s*تحسنو", r"لو\s*(زادو|تحسنو|رفعو)", r"نشاء\s*الله\s*يتحسن", r"إن\s*شاء\s*الله\s*يتحسن", r"المزيد\s*من\s*(الجهود|التحسين|التطوير)", r"نأمل\s*(في\s*)?(تحسين|تطوير)",
    r"نتمنى\s*(تطوير|تحسين)", r"يجب\s*(تحسين|تطوير|رفع)", r"أتمنى\s*(أن\s*)?(يتحسن|تحسين)", r"نقص\s*في\s*(السعر|الخدمة|التغطية)", r"لو\s*كان\s*السعر\s*(أقل|منخفض)", r"لو\s*تخفضو\s*السعر", r"ينقصه?\s*(فقط|بس)", r"ينقص\s*(شوية|قليل|قليلاً)",
)
SUGGESTION_NEGATIVE = (
    r"\bnul\b", r"\bkhaybe?\b", r"\bkhayba?\b", r"\bmachi\s*barka\b", r"\bkarica\b", r"\bkhartha?\b", r"كارثة", r"كارثه", r"كارثي[هة]?", r"فضيحة", r"مهزلة", r"\bzero\b", r"تحت\s*الصفر", r"لا\s*يعمل", r"ما\s*يخدم", r"مايخدمش", r"مقطوع[هة]?", r"قطوع\b", r"coupure\b", r"انقطاع\b", r"شكوى", r"شكاية", r"شكاوي", r"مشكل[ةه]?", r"مشاكل\b",
    r"r[eé]clamation\b", r"plainte\b", r"\d+\s*(أشهر|mois|شهر|jours?|أيام|ايام)\s*(بدون|sans|دون|ولم)", r"شهرين.*ما\s*ركب", r"ست\s*اشهر", r"مازال\s*(ما|لم)\s*(جا[ءو]?|ركب)", r"تعبتونا", r"هرمنا", r"هبلتونا", r"وعود\s*كاذبة", r"مافيا\b", r"فساد\b", r"هل\s*يعقل", r"والله.*يا\s*(ذيك|راحه)", r"في\s*الأحلام\b", r"في\s*المنام\b",
)


def social(c: Column) -> Column:
    """1 for wishes and thanks that no complaint cancels, else 0."""
    return F.when(meets(c, SOCIAL) & ~meets(c, SOCIAL_NEGATIVE), 1).otherwise(0)


def complaint(c: Column, implicit: int = -1) -> Column:
    """Anger; official replies; requests for contact with or without frustration, which alone give ``implicit``."""
    contact, trouble = meets(c, CONTACT), meets(c, FRUSTRATION, dotall=True)
    rows = (
        (meets(c, ANGER), _flag(1, "neglex")),
        (meets(c, OFFICIAL_REPLY) & ~trouble, _flag(-1, "at_response")),
        (contact & trouble, _flag(1, "prv")),
        (contact & meets(c, POLITE), _flag(0, None)),
        (contact, _flag(implicit, "prv_implicit")),
    )
    return _table(rows, _flag(0, None))


def suggestion(c: Column) -> Column:
    """Praise with a reservation: with a wish for better, masked by strong blame, or alone."""
    reserved = meets(c, SUGGESTION_POSITIVE) & meets(c, CONTRAST)
    better, blame = meets(c, IMPROVE), meets(c, SUGGESTION_NEGATIVE, dotall=True)
    rows = ((reserved & better & blame, _flag(-1, "masked_neg")), (reserved & better, _flag(1, "pur")), (reserved & ~blame, _flag(1, "pos_adv")))
    return _table(rows, _flag(0, None))


def _table(rows: tuple[tuple[Column, Column], ...], default: Column) -> Column:
    """The result of the first condition that holds."""
    out = default
    for condition, result in reversed(rows):
        out = F.when(condition, result).otherwise(out)
    return out


#: The lexicons by name.
LEXICONS = {
    "mixte_positif": MIXED_POSITIVE, "mixte_negatif": MIXED_NEGATIVE, "encouragement": ENCOURAGEMENT, "hors_sujet": OFF_TOPIC, "produit": PRODUCT, "negation": NEGATION, "negation_positif": NEGATION_POSITIVE, "negation_negatif": NEGATION_NEGATIVE,
    "social": SOCIAL, "contact": CONTACT, "colere": ANGER, "poli": POLITE, "reponse_officielle": OFFICIAL_REPLY, "contraste": CONTRAST, "amelioration": IMPROVE,
}
#: Single ASCII words of the positive and negative lexicons.
COMMON_WORDS = tuple(dict.fromkeys(w for x in (MIXED_POSITIVE, MIXED_NEGATIVE, NEGATION_POSITIVE, NEGATION_NEGATIVE, PRODUCT, CONTRAST) for p in x if re.fullmatch(r"[a-z0-9]+", w := p.replace("\\b", ""))))
