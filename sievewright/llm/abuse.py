"""Problem 6: scores for abusive, hateful and sexually explicit language, and rates by source.

Weak supervision in three steps:

1. many voters, word lists and patterns in ten languages, vote on every sentence; one pass of an
   Aho-Corasick automaton over a record finds all their words.  One voter of each kind looks for what
   speaks against it: medical, technical and quoting use;
2. a label model (:func:`sievewright.llm.labelmodel.fit_correlated`) learns from the counts of all vote
   patterns, those of sentences without any cue included, how far each voter is to be trusted and
   which voters depend on each other, and gives each pattern a posterior;
3. a linear classifier on words, word pairs and what the voters say is trained on the posteriors of a bounded sample of
   sentences (``SAMPLE`` of each sort with the least hash, six times as many without any cue, four times as many
   with words that speak against only) and then
   scores every sentence of every record.  A record's score of a kind is that of its worst sentence.

Before either, a text is brought to one form, and obfuscation is undone: look-alikes, letters set
apart, figures for letters, masked letters of listed words, letters drawn out.  The same pass writes
each record's words as hashes, so that scoring reads these and no text again.  A sentence of more
than ``WINDOW`` words, as of text without stops, is scored as a whole and by windows of that length.

Defined results: null and blank texts score 0 in every kind; a repeated id is one record, with the
highest of its scores; a null source counts as unknown; without any positive sample every score is 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm import labelmodel
from sievewright.llm.records import text_lists
from sievewright.llm.tokens import clean_label
from sievewright.llm.visual import canonical_form, word_ready
from sievewright.session import materialize

KINDS = ("abusive", "hateful", "sexual")
SAMPLE = 1_500
BITS = 18
CUTOFF = 0.7
#: First belief that a sentence is of the kind if a common word of it is found.
COMMON_TRUST = 0.45
#: Longest stretch scored as one; longer sentences, as of text without stops, are scored by windows.
WINDOW = 26

# Word lists of the voters, one line for each language (en de fr es pt it bg ru ar zh).  They hold common
# words and turns of speech, each list another sort of evidence.
LISTS_TEXT = {
    "insult": """
idiot; moron; trash; loser; clown; scum; imbecile; pathetic; worthless; bastard; asshole; dumbass; stupid; dumb; jerk; retard; bitch; disgusting pig; coward; piece of shit
idiot; schwachkopf; vollpfosten; dreck; versager; trottel; arschloch; dummkopf; abschaum; wichser; penner; hurensohn; vollidiot; drecksau; feigling
imbécile; abruti; crétin; ordure; raté; connard; salaud; débile; minable; bouffon; pauvre type; enculé; salope; déchet; lâche
idiota; imbécil; basura; payaso; fracasado; estúpido; inútil; patético; gilipollas; cabrón; escoria; tarado; pendejo; cobarde
idiota; parvalhão; lixo; falhado; palhaço; estúpido; inútil; patético; cretino; cabrão; otário; imbecil; canalha; burro; covarde; fracassado
idiota; cretino; spazzatura; fallito; pagliaccio; stupido; stronzo; patetico; feccia; imbecille; deficiente; bastardo; vigliacco
идиот; кретен; боклук; неудачник; тъпак; глупак; нищожество; жалък; мръсник; малоумник; олигофрен; простак; палячо; страхливец
идиот; кретин; тупица; дерьм; неудачник; дурак; урод; мразь; дебил; ничтожество; придурок; сволочь; жалкий; мусор; трус
غبي; قمامة; حقير; أحمق; فاشل; تافه; كلب; حمار; وغد; سافل; معتوه; بليد; جبان
白痴; 蠢货; 废物; 人渣; 下贱; 笨蛋; 傻逼; 混蛋; 垃圾; 贱人; 畜生; 蠢猪; 失败者; 小丑; 懦夫
""",
    "dismiss": """
shut up; shut your; get lost; go away; piss off; fuck off; fuck you; screw you; go to hell; get out of my
halt die klappe; die klappe; halt dein maul; halt den mund; verpiss dich; hau ab; verschwinde; fick dich; geh zum teufel; scher dich
ta gueule; ferme-la; ferme ta; dégage; casse-toi; va te faire; fous le camp; tais-toi; va au diable
cállate; cierra la boca; cierra el pico; lárgate; vete a la mierda; vete al infierno; que te jodan; piérdete
cala a boca; cala-te; desaparece; vai à merda; vai para o inferno; vai-te foder; some daqui; põe-te a andar
stai zitto; chiudi la bocca; chiudi quella; sparisci; vaffanculo; vai al diavolo; levati; vai a quel paese; taci
млъкни; затваряй си; затвори си устата; изчезвай; махай се; върви по дяволите; разкарай се
заткнись; закрой рот; проваливай; иди к чёрту; иди к черту; пошёл вон; пошел вон; отвали; убирайся; катись
اخرس; اسكت; اغرب عن; انصرف; اذهب إلى الجحيم; أغلق فمك; ابتعد عني
闭嘴; 住口; 滚开; 滚蛋; 滚出; 给我滚; 快滚; 去你的
""",
    "harm": """
kill yourself; drop dead; go die; you should die; hope you die; hope you choke; hope you rot; hope you suffer; choke on; rot in hell; burn in hell; hang yourself
bring dich um; stirb; verreck; krepier; erstick; häng dich auf; in der hölle
crève; va mourir; étouff; pends-toi; suicide-toi; en enfer
muérete; te mueras; atragant; mátate; púdrete; revienta; ahórcate
morras; mata-te; engasg; apodrece; enforca-te; se mate
muori; crepa; ammazzati; strozz; marcisci; impiccati; all'inferno
умри; да пукнеш; пукни; гръмни се; обеси се; задави; убий се; да умреш
сдохни; чтоб ты; убей себя; повесься; подави; умри; гори в аду
انتحر; اقتل نفسك; تموت; تختنق; جهنم; اشنق نفسك
去死; 自杀吧; 噎死; 不得好死; 死全家; 下地狱; 怎么不死
""",
    "contempt": """
nobody wants you; nobody likes you; no one likes you; no one wants you; nobody cares about you; waste of space; waste of oxygen; waste of air; you make me sick; you disgust me; you are nothing; ashamed of yourself; go cry; go and cry; cry about; good for nothing
niemand will dich; niemand mag dich; keiner mag dich; keiner will dich; du bist nichts; widerst mich an; schäm dich; heul; zu nichts zu gebrauchen; platzverschwendung
personne ne veut de toi; personne ne t'aime; tu me dégoûtes; tu n'es rien; va pleurer; honte à toi; bon à rien; ne vaux rien
nadie te quiere; nadie te soporta; me das asco; no vales nada; no eres nadie; a llorar; vete a llorar; no sirves para nada
ninguém te quer; ninguém gosta de; metes-me nojo; nojo de ti; não vales nada; não prestas; vai chorar; chorar para
nessuno ti vuole; nessuno ti sopporta; mi fai schifo; non vali niente; non sei nessuno; a piangere; buono a nulla; vergognati
никой не те иска; никой не те харесва; отвращаваш ме; нищо не струваш; гади ми се; плачеш; за нищо не ставаш
никому ты; ты здесь не нужен; никто тебя не; тошнит от тебя; ты никто; ничего не стоишь; поплачь; иди плачь; позорище
لا أحد يريدك; لا أحد يحبك; أنت لا شيء; تثير اشمئزازي; لا قيمة لك; وابك; اذهب وابك; عار عليك
没人想见; 没人喜欢你; 没人要你; 你算什么; 真恶心; 一文不值; 去哭; 哭吧; 丢人现眼
""",
    "dehumanise": """
vermin; parasites; subhuman; cockroaches; savages; leeches; inferior race; filthy; infest; disgusting people
ungeziefer; parasiten; untermensch; schmarotzer; gesindel; minderwertig; dreckig; kakerlaken; dieses pack$
vermine; parasites; sous-hommes; cafards; racaille; sale race; inférieur; sauvages
alimañas; parásitos; subhumanos; cucarachas; asqueros; raza inferior; salvajes; plaga
bichos; parasitas; sub-humanos; baratas; imund; raça inferior; escumalha; nojent; selvagens
parassiti; subumani; scarafaggi; schifos; razza inferiore; feccia; selvaggi; sporca
паразити; хлебарки; мръсна; низша раса; гадини; мръсно; вредители; измет; пасмина
паразит; тараканы; низшая раса; недочеловек; отбросы; нечисть; вредител; твари; грязн
حشرات; طفيليات; صراصير; جرذان; قذر; عرق أدنى; همج
害虫; 寄生虫; 蟑螂; 劣等; 贱种; 低等; 肮脏; 野蛮人
""",
    "slander": """
liars; thieves; criminals; rapists; animals; a disease; plague; breed$; ruin; take our jobs; too stupid; belong in the kitchen; lazy$
lügner; diebe; kriminelle; vergewaltiger; tiere; seuche; ruinier; zu dumm; an den herd; faul
menteurs; voleurs; criminels; violeurs; animaux; une maladie; peste; gâch; trop bêtes; retourner à la cuisine; paresseux
mentirosos; ladrones; delincuentes; violadores; animales; una enfermedad; arruina; demasiado tont; vuelvan a la cocina; vagos
mentirosos; ladrões; criminosos; violadores; animais; uma doença; estraga; arruína; voltem para a cozinha; preguiçosos
bugiardi; ladri; criminali; stupratori; animali; una malattia; rovina; troppo stupid; tornino in cucina; pigri
лъжци; крадци; престъпници; насилници; животни; зараза; съсипва; разваля; прекалено глупав; да си стоят в кухнята; мързелив
лжец; лжецы; врут; воры; преступник; насильник; животные; зараза; портит; портят; слишком тупые; марш на кухню; ленив
كذاب; لصوص; مجرم; مغتصب; حيوانات; وباء; تفسد; أغبى من; إلى المطبخ; كسال
骗子; 小偷; 罪犯; 强奸犯; 动物; 瘟疫; 毁掉; 太蠢; 回厨房; 懒惰
""",
    "exclude": """
thrown out of; kick them out; kicked out; deport; send them back; go back to where; no rights; any rights; not deserve; burn down; never hire; not hire; wiped out; exterminat; get rid of; should be shot; hang them; not welcome here; not belong here
aus dem land; abschieben; abgeschoben; keine rechte; anzünden; niederbrennen; keine einstellen; ausgerottet; ausrotten; raus aus; loswerden; haben hier nichts; stellt bloß keine; stellt bloss keine
hors du pays; expuls; aucun droit; brûler; n'embauche; extermin; dehors; renvoyer chez; se débarrasser; ne méritent
echarlos; expuls; fuera del país; ningún derecho; no merecen; quemar; no contrat; extermin; deshacerse; no son bienvenid
expuls; fora do país; não merecem; quaisquer direitos; nenhum direito; queimar; nunca contrat; extermin; livrar-nos; não são bem-vind
cacciati; espuls; fuori dal paese; alcun diritto; non meritano; bruciare; non assum; stermin; liberarci; non sono benvenut
изгонени; изгонят; да се махат; никакви права; не заслужават; изгорим; изгорят; не наемай; изтреб; да се отървем; не взимайте на работа; не назначавай
гнать из; выгнать; вышвырн; никаких прав; не заслуживают; сжечь; не нанимай; истреб; вон из; избавиться; не берите на работу; убираются
طردهم; اطردوا; اطردوهم; أي حقوق; لا يستحقون; نحرق; لا توظف; توظفوهم; إبادة; التخلص من; ارحلوا
赶出; 驱逐; 任何权利; 不配; 烧掉; 别雇; 不要雇; 灭绝; 滚出; 除掉; 不欢迎
""",
    "generalise": """
all of them; every one of them; they are all; these people; those people; all those; people like them; their kind; none of them; all the
sie alle; alle diese; diese leute; die sind alle; solche leute; jeder von denen; keiner von denen; alle
tous ces; ces gens; ils sont tous; toutes ces; tous les; aucun d'eux; gens-là
todos esos; todos ellos; esa gente; esta gente; son todos; todos los; ninguno de ellos; gente como
todos esses; todos eles; essa gente; esta gente; são todos; todos os; nenhum deles; gente como
tutti quei; tutti loro; questa gente; quella gente; sono tutti; tutti i; nessuno di loro; gente come
всички тези; всички те; тези хора; всички са; такива хора; никой от тях; всички
все эти; все они; эти люди; такие люди; никто из них; всех этих; все
كلهم; جميعهم; كل هؤلاء; هؤلاء الناس; أمثالهم; جميع; كل
这些人; 那些人; 他们都; 他们全; 所有; 这种人; 一个个都; 全都
""",
    "demand": """
should; must; have to; ought to; time to
sollte; müssen; muss man; gehören; verdienen
devrait; faut; doivent; il est temps
habría que; hay que; deberían; debemos; tienen que
devia; devíamos; é preciso; têm de; deveriam
bisognerebbe; bisogna; dovrebbero; devono; dobbiamo
трябва; да ги; нека
надо; нужно; должны; пора; следует
يجب; ينبغي; لا بد
应该; 必须; 得把; 就该
""",
    "groups": """
immigrants; foreigners; refugees; migrants; muslims; jews; blacks; gays; lesbians; women; gypsies; arabs; asians; africans; disabled people; ethnic
einwanderer; ausländer; flüchtlinge; migranten; muslime; juden; schwarze; schwule; lesben; frauen; zigeuner; araber; behinderte
immigrés; étrangers; réfugiés; migrants; musulmans; juifs; noirs; homosexuels; femmes; gitans; arabes; handicapés
inmigrantes; extranjeros; refugiados; musulmanes; judíos; negros; homosexuales; mujeres; gitanos; árabes; discapacitados
imigrantes; estrangeiros; refugiados; muçulmanos; judeus; negros; homossexuais; mulheres; ciganos; árabes; deficientes
immigrati; stranieri; rifugiati; migranti; musulmani; ebrei; neri; omosessuali; donne; zingari; arabi; disabili
имигранти; чужденци; бежанци; мюсюлмани; евреи; чернокожи; хомосексуалисти; жени; цигани; араби; инвалиди
иммигрант; иностранц; беженц; мигрант; мусульман; евре; чернокож; геи; женщины; цыган; араб; инвалид
المهاجرين; الأجانب; اللاجئين; المسلمين; اليهود; السود; المثليين; النساء; الغجر; المعاقين
移民; 外国人; 难民; 穆斯林; 犹太人; 黑人; 同性恋; 女人; 吉普赛人; 残疾人
""",
    "act": """
sex$; fucked; fucking her; blowjob; hardcore; porn; masturbat; orgasm; went down on; made love; anal; cum on
sex$; gefickt; fickten; trieben es; orgasmus; porno; geblasen; masturb; liebten sich
baise; baisèrent; l'amour; porno; orgasme; masturb; sucer; faire jouir
follar; follaron; sexo$; porno; orgasmo; masturb; hicieron el amor; mamada
foder; foderam; sexo$; porno; orgasmo; masturb; fizeram amor; broche
scopare; scoparono; sesso$; porno; orgasmo; masturb; fecero l'amore; pompino
чукаха; чукат; секс$; порно; оргазъм; мастурб; правиха любов; свирка
трахал; трахат; секс$; порно; оргазм; мастурб; занимались любовью; минет
الجنس; جنسا; إباحي; مارسا; نشوة; استمنا; جماع
性交; 做爱; 色情; 高潮; 手淫; 口交; 上床
""",
    "nudity": """
naked; nude$; nudes$; nipples; topless; undressed; tore off; stripped; breasts; penis; vagina; genitals
nackt; brüste; brustwarzen; kleider vom; entblöß; penis; vagina; zog sich aus
nue$; nues$; nus$; seins; tétons; arracha ses; vêtements; se déshabill; pénis; vagin
desnud; pechos; pezones; arrancó la; ropa$; pene$; vagina; sin ropa
nua$; nus$; seios; mamilos; arrancou; roupa; despi; pénis; pênis; vagina
nuda$; nudi$; seni$; capezzoli; strappò; vestiti; spogli; pene$; vagina
голи; гола; гърди; зърна; разкъса; дрехите; съблякоха; съблече; пенис; вагина
голая; голую; голые; догола; грудь; соски; сорвал; одежд; раздел; пенис; вагин
عاري; العاري; تعرى; عارية; صدرها; ثيابها; مزق; قضيب; مهبل
裸; 胸部; 乳头; 脱光; 脱得精光; 衣服; 阴茎; 阴道
""",
    "arousal": """
horny; turned on; moan; aroused; lust$; erect$; kissed her; groan; panting; caress
geil$; stöhn; erregt; wollüstig; küsste; streichel
excité; gémi; bander; désir; caress; embrassa
calient; gemía; gimi; excitad; lujuria; acarici; besó
tesão; gemia; gemi; excitad; luxúria; acarici; beijou
eccitat; gemeva; gemi; lussuria; arrapat; accarezz; baciò
възбуд; стене; стенеше; похот; разгорещ; галеше; целуна
возбужд; стонал; стон; похот; ласкал; целовал
مثار; تتأوه; شهوة; يتأوه; يداعب
欲火; 呻吟; 情欲; 性欲; 抚摸; 勃起; 吻
""",
    "solicit": """
nude pictures; naked pictures; nudes; send me a picture; pictures of you; photos of you; sleep with me; sex with you; sexting
nacktbilder; nacktfotos; bilder von dir; fotos von dir; schlaf mit mir; sex mit dir
photos de toi; images de toi; coucher avec moi; couche avec moi; baiser toute
fotos tuyas; imágenes tuyas; acuéstate conmigo; sexo contigo; tu cuerpo
fotos tuas; fotografias tuas; imagens tuas; dorme comigo; sexo contigo; o teu corpo
foto di te; immagini di te; vieni a letto; sesso con te; il tuo corpo
голи снимки; твои снимки; снимки на теб; спи с мен; секс с теб
голые фото; твои фото; фото без одежды; переспи со мной; секс с тобой
صورك; صورا; صورة لك; نم معي; الجنس معك
裸照; 你的照片; 跟我睡; 和我上床; 约炮
""",
}
#: What speaks for medical, technical or quoting use.
AGAINST = """
cancer; screening; health; medical; patient; doctor; clinic; anatomy; contracept; bug$; bugs$; terminal; process; server; thread; quoted; quote; the word; policy; rule; forbid; prohibit; not allowed; guideline; report; critic; film; novel; article; eye
krebs; vorsorge; gesundheit; medizin; patient; arzt; klinik; anatomie; prozess; terminal; server; fehler; zitat; das wort; verbiet; verboten; regel; hausordnung; ordnung; vorschrift; richtlinie; bericht; kritiker; film; roman; artikel; auge
cancer; dépistage; santé; médic; patient; médecin; clinique; anatomie; processus; terminal; serveur; bogue; cité; le mot; interdi; règle; rapport; critique; film; roman; article; oeil; œil
cáncer; revisión; salud; médic; paciente; clínica; anatomía; proceso; terminal; servidor; error; cita; la palabra; prohíb; norma; regla; informe; crítico; película; novela; artículo; vista
cancro; câncer; rastreio; saúde; médic; paciente; clínica; anatomia; processo; terminal; servidor; erro; cita; a palavra; proíb; regra; regulamento; relatório; crítico; filme; romance; artigo; olho
tumore; cancro; screening; salute; medic; paziente; clinica; anatomia; processo; terminale; server; errore; cita; la parola; viet; regol; rapporto; critico; film; romanzo; articolo; occhio
рак; преглед; здрав; медицин; пациент; лекар; клиника; анатоми; процес; терминал; сървър; грешк; бъг; цитат; думата; забран; правил; доклад; критик; филм; роман; статия; око
рак; обследован; здоров; медицин; пациент; врач; клиник; анатоми; процесс; терминал; сервер; ошибк; баг; цитат; слово; запре; правил; доклад; критик; фильм; роман; статья; глаз
سرطان; فحص; صحة; الصحة; طبي; مريض; طبيب; عيادة; تشريح; عملية; العملية; الطرفية; خادم; خطأ; اقتباس; كلمة; تمنع; ممنوع; قاعدة; لائحة; تقرير; ناقد; فيلم; رواية; مقال; بالعين
癌; 筛查; 健康; 医; 患者; 诊所; 解剖; 进程; 终端; 服务器; 漏洞; 错误; 引用; 这个词; 禁止; 规定; 不得; 不许; 报告; 评论家; 电影; 小说; 文章; 肉眼
"""
_TARGET = re.compile(
    r"\b(?:you|your|du|dich|dir|tu|toi|te|ti|tú|eres|és|sei)\b|\b(?:t|ту|ты|tы|ти|tи|tе|те|тeбя)\b|(?:أنت|يريدك|يا )|你"
)
#: The voters of each kind: the lists, and what is read beside them.
VOTERS = {
    "abusive": ("insult", "dismiss", "harm", "contempt", "target", "context"),
    "hateful": ("dehumanise", "slander", "exclude", "generalise", "demand", "groups", "context"),
    "sexual": ("act", "nudity", "arousal", "solicit", "context"),
}

_LEET = str.maketrans("013457@$", "oieastas")
_TOKEN = re.compile(r"[㐀-鿿]|[^\W_㐀-鿿]+(?:['’\-*@$]+[^\W_㐀-鿿]+)*|[。！？；…]+|[.!?;؟]+(?!\w)|\n\s*(?=[\n\-*#>•])|\x00")
_STOP = re.compile(r"[.!?;。！？；؟…\n\x00]")
_DRAWN = re.compile(r"(.)\1{2,}")
_APART = re.compile(r"(?: [^\W\d_㐀-鿿]){4,}(?= )")
_DRAWN_HAN = re.compile(r"( [㐀-鿿])\1{2,}")


def _token(token: str) -> str:
    """One token with obfuscation undone; sentence breaks become a full stop."""
    if _STOP.match(token):
        return "."
    token = canonical_form(token) or token
    if token.isalpha():
        return _DRAWN.sub(r"\1", token)
    if "-" in token and all(len(x) == 1 for x in token.split("-")):
        token = token.replace("-", "")  # letters set apart
    if "*" in token:
        masked = re.compile(re.escape(token).replace(r"\*", "."))
        token = next((w for w in _VOCABULARY.get(len(token), ()) if masked.fullmatch(w)), token)
    if any(c.isalpha() for c in token) and any(c in "013457@$" for c in token):
        token = token.translate(_LEET)  # figures for letters
    return _DRAWN.sub(r"\1", token)


class _Tokens(dict):
    """Normal forms of tokens as they come, each made once; bounded."""

    LIMIT = 500_000

    def __missing__(self, token: str) -> str:
        if len(self) >= self.LIMIT:
            self.clear()
        self[token] = form = _token(token)
        return form


def plain(text: str, forms: _Tokens | None = None) -> str:
    """The tokens of a text in normal form, with a space before and after each."""
    forms = _Tokens() if forms is None else forms
    text = f" {' '.join(map(forms.__getitem__, _TOKEN.findall(word_ready(text.lower()))))} "
    text = _APART.sub(lambda m: " " + m.group().replace(" ", ""), text)
    if not text.isascii():
        text = _DRAWN_HAN.sub(r"\1", text)
    return text


def _terms(block: str) -> list[str]:
    """Terms in the form of :func:`plain`; except in Arabic, where words take prefixes, from a word's begin,
    and to a word's end where ``$`` says so."""
    out = []
    for line in block.strip().splitlines():
        for t in filter(None, map(str.strip, line.split(";"))):
            form = plain(t.removesuffix("$")).rstrip() + " " * t.endswith("$")
            out.append(form.strip() if "\u0600" <= form.strip()[0] <= "\u06ff" else form)
    return out


_VOCABULARY: dict[int, list[str]] = {}
LISTS = {name: _terms(block) for name, block in LISTS_TEXT.items()}
_CUES = ahocorasick.Automaton()
for _name, _list in (*LISTS.items(), ("context", _terms(AGAINST))):
    for _t in _list:
        _CUES.add_word(_t, _CUES.get(_t, ()) + (_name,))
_CUES.make_automaton()
for _w in sorted({w for terms in LISTS.values() for t in terms for w in t.split()}):
    _VOCABULARY.setdefault(len(_w), []).append(_w)
#: Lists whose words are common: they speak only beside one of the others of their kind.
_COMMON = frozenset(("context", "generalise", "demand", "groups", "slander", "nudity", "arousal"))
#: What a sentence without any of its words is voted, for each kind.
NO_CUE = {kind: "-" * len(voters) for kind, voters in VOTERS.items()}


def _votes(said: set[str], sentence: str) -> dict[str, str]:
    """The vote patterns; common words count where they come together with others of their kind."""
    out = {}
    for kind, voters in VOTERS.items():
        mine = said.intersection(voters)
        mine.discard("context")
        if kind == "hateful" and mine <= _COMMON:  # slander is one if it is said of a group
            mine = mine if "slander" in mine and mine & {"generalise", "groups"} else set()
        elif mine <= _COMMON:
            mine = mine if len(mine) > 1 else set()
        if mine and kind == "abusive" and _TARGET.search(sentence):
            mine.add("target")
        if mine and "context" in said:
            mine.add("context")
        out[kind] = "".join("+" if v in mine else "-" for v in voters) if mine else NO_CUE[kind]
    return out


def voted_sentences(text: str) -> Iterator[tuple[str, dict[str, str], bool, bool]]:
    """The sentences of a text in plain form, each with its vote patterns, + or - of each voter, and
    whether any voter has spoken."""
    hits = list(_CUES.iter(text))
    at, i = 0, 0
    for piece in text.split(" . "):
        end = at + len(piece)
        said: set[str] = set()
        while i < len(hits) and hits[i][0] < end + 1:
            said.update(hits[i][1])
            i += 1
        at = end + 3
        if piece.strip(" ."):
            sentence = f" {piece.strip()} "
            votes = _votes(said, sentence) if said else NO_CUE
            yield sentence, votes, votes != NO_CUE, "context" in said


def vote(sentence: str) -> dict[str, str] | None:
    """Vote patterns of a sentence in plain form; None if no voter speaks."""
    return next((v for _, v, speaks, _ in voted_sentences(sentence) if speaks), None)


def _hash(word: str) -> int:
    return zlib.crc32(word.encode()) & ((1 << BITS) - 1)


@dataclass
class Classifier:
    """Weights of words and of word pairs, hashed, for each kind, and the biases."""

    words: np.ndarray
    pairs: np.ndarray
    bias: np.ndarray

    def token_scores(self, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Of each token, its weight and that of the pair with the token before it in the sentence."""
        out = self.words[ids].copy()
        if len(ids) > 1:
            both = self.pairs[_pair(ids[:-1], ids[1:])]
            both[begins[1:]] = 0
            out[1:] += both
        return out


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a.astype(np.int64) * 40_503 + b.astype(np.int64) * 9_973 + 7) ^ (a.astype(np.int64) >> 5)) & ((1 << BITS) - 1)


def train(samples: list[tuple[str, list[float]]], epochs: int = 60, rate: float = 0.2, decay: float = 3e-4) -> Classifier:
    """Logistic regression of each kind on soft labels, by Adam over all samples at once."""
    size, kinds = 1 << BITS, len(KINDS)
    words, pairs = np.zeros((size, kinds), np.float32), np.zeros((size, kinds), np.float32)
    bias = np.full(kinds, -3.0, np.float32)
    rows_w, cols_w, rows_p, cols_p, labels = [], [], [], [], []
    for text, label in samples:
        said = vote(text)
        ids = np.array([_hash(t) for t in (*text.split(), *(marks(said) if said else ())) if t != "."], np.int64)
        if not len(ids):
            continue
        u = np.unique(ids)
        p = np.unique(_pair(ids[:-1], ids[1:]))
        rows_w.append(np.full(len(u), len(labels)))
        cols_w.append(u)
        rows_p.append(np.full(len(p), len(labels)))
        cols_p.append(p)
        labels.append(label)
    if not labels:
        return Classifier(words, pairs, np.full(kinds, -20.0, np.float32))
    rw, cw, rp, cp = (np.concatenate(x) for x in (rows_w, cols_w, rows_p, cols_p))
    y = np.array(labels, np.float32)
    # Each kind's positives weigh as much as the rest, up to a bound.
    weight = np.where(y > 0.5, np.minimum(3.0, len(y) / (2 * np.maximum(1, (y > 0.5).sum(axis=0)))), 1.0).astype(np.float32)
    used_w, back_w = np.unique(cw, return_inverse=True)
    used_p, back_p = np.unique(cp, return_inverse=True)
    params = [np.zeros((len(used_w), kinds), np.float32), np.zeros((len(used_p), kinds), np.float32), bias]
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in params]
    for step in range(1, epochs + 1):
        z = np.zeros_like(y) + params[2]
        np.add.at(z, rw, params[0][back_w])
        np.add.at(z, rp, params[1][back_p])
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        gw, gp = np.zeros_like(params[0]), np.zeros_like(params[1])
        np.add.at(gw, back_w, g[rw])
        np.add.at(gp, back_p, g[rp])
        for x, gx, (m, v) in zip(params, (gw + decay / 10 * params[0], gp + decay / 10 * params[1], g.sum(axis=0)), state):
            m *= 0.9
            m += 0.1 * gx
            v *= 0.99
            v += 0.01 * gx * gx
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    # The label model makes voters' words decisive; a kind without any positive label stays at 0.
    absent = (y > 0.5).sum(axis=0) == 0
    words[used_w], pairs[used_p] = params[0], params[1]
    words[:, absent] = pairs[:, absent] = 0
    return Classifier(words, pairs, np.where(absent, -20.0, params[2]).astype(np.float32))


class _Hashes(dict):
    """Of the words of a text in plain form the hash, -1 for a sentence break; bounded."""

    LIMIT = 500_000

    def __missing__(self, form: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[form] = h = -1 if form == "." else _hash(form)
        return h


def marks(votes: dict[str, str]) -> list[str]:
    """What the voters say, as words of their own, so that a listed word counts that no sample has."""
    return [f"\x01{kind}-{v}" for kind, voters in VOTERS.items() for v, said in zip(voters, votes[kind]) if said == "+"]


def stream(text: str, hashes: _Hashes) -> np.ndarray:
    """The hashes of the words of a text in plain form, with the marks of each sentence after it."""
    ids: list[int] = []
    for sentence, votes, said, _ in voted_sentences(text):
        ids.extend(map(hashes.__getitem__, sentence.split()))
        if said:
            ids.extend(map(hashes.__getitem__, marks(votes)))
        ids.append(-1)
    return np.array(ids, np.int32)


def scores(model: Classifier, streams: list[np.ndarray]) -> np.ndarray:
    """The scores of each stream of words: of each kind the highest of any sentence."""
    out = np.full((len(streams), len(KINDS)), -30.0)
    lengths = np.array([len(s) + 1 for s in streams])
    flat = np.concatenate([np.concatenate((s, [-1])) for s in streams]) if streams else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(streams)), lengths)
    word = flat >= 0
    if not word.any():
        return np.zeros((len(streams), len(KINDS)))
    sentence = np.cumsum(~word)[word]
    ids, owner = flat[word], owner[word]
    begins = np.concatenate(([True], sentence[1:] != sentence[:-1]))
    cumulated = np.concatenate((np.zeros((1, len(KINDS))), np.cumsum(model.token_scores(ids, begins), axis=0, dtype=np.float64)))
    starts = np.flatnonzero(begins)
    ends = np.concatenate((starts[1:], [len(ids)]))
    long = np.flatnonzero(ends - starts > WINDOW)
    if len(long):
        more = [np.arange(starts[i], ends[i] - WINDOW + 5, 5) for i in long]
        more_starts = np.concatenate(more)
        more_ends = np.minimum(more_starts + WINDOW, np.concatenate([np.full(len(m), ends[i]) for m, i in zip(more, long)]))
        starts, ends = np.concatenate((starts, more_starts)), np.concatenate((ends, more_ends))
    z = cumulated[ends] - cumulated[starts] + model.bias
    np.maximum.at(out, owner[starts], z)
    return 1 / (1 + np.exp(-out))


_PASS = "part string, record_id string, source string, words binary, sentence string, abusive string, hateful string, sexual string, n long, h long"
_COLUMNS = [c.split()[0] for c in _PASS.split(", ")]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over the texts.  Rows of three parts: ``words``, the stream of each record; ``vote``, each
    sentence with a cue and its votes; of one record in 8 a sentence without any (``spare``) and those
    with a word of the lists against only (``against``); ``count``, how many sentences that aren't
    written have a vote pattern."""
    forms, hashes = _Tokens(), _Hashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            b = batch.slice(at, 2048)
            out: dict[str, list] = {c: [] for c in _COLUMNS}
            counts: dict[tuple[str, ...], int] = {}

            def add(part: str, **values) -> None:
                for c in _COLUMNS[1:]:
                    out[c].append(values.get(c))
                out["part"].append(part)

            for record, source, texts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_lists(b, "__text")):
                text = plain("\n\x00\n".join(texts), forms) if texts else ""
                ids: list[int] = []
                chosen = zlib.crc32(str(record).encode()) % 8 == 0
                spare = None
                for sentence, v, said, legit in voted_sentences(text):
                    ids.extend(map(hashes.__getitem__, sentence.split()))
                    if said:
                        ids.extend(map(hashes.__getitem__, marks(v)))
                    ids.append(-1)
                    if said:
                        add("vote", sentence=sentence, n=1, h=zlib.crc32(f"{record}{sentence}".encode()), **v)
                        continue
                    key = tuple(v.values())
                    counts[key] = counts.get(key, 0) + 1
                    if chosen and legit:
                        add("against", sentence=sentence, n=0, h=zlib.crc32(f"{record}{sentence}".encode()))
                    elif chosen and (spare is None or zlib.crc32(f"{record}{sentence}".encode()) < spare[0]):
                        spare = (zlib.crc32(f"{record}{sentence}".encode()), sentence)
                add("words", record_id=record, source=source, words=np.array(ids, np.int32).tobytes())
                if spare is not None:
                    add("spare", sentence=spare[1], n=0, h=spare[0])
            for key, n in counts.items():
                add("count", n=n, **dict(zip(KINDS, key)))
            types = {"words": pa.binary(), "n": pa.int64(), "h": pa.int64()}
            yield pa.record_batch([pa.array(v, types.get(c, pa.string())) for c, v in out.items()], _COLUMNS)


def _score(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                result = scores(model, [np.frombuffer(w, np.int32).astype(np.int64) for w in b.column(3).to_pylist()])
                result[result < 1e-6] = 0.0
                yield pa.record_batch([b.column(0), b.column(1), b.column(2), *(pa.array(result[:, k]) for k in range(len(KINDS)))], ["table_name", "record_id", "source", *KINDS])

    return run


def read(docs: DataFrame, sft: DataFrame) -> DataFrame:
    """The pass over all records of both tables, written; see :func:`_read`."""
    inputs = (
        ("documents", docs.select(F.col("doc_id").cast("string").alias("record_id"), clean_label("source").alias("source"), F.col("text").alias("__text"))),
        ("sft_rows", sft.select(F.col("id").alias("record_id"), clean_label("source_id").alias("source"), F.col("messages").alias("__text"))),
    )
    parts = [df.where("record_id is not null").mapInArrow(_read, _PASS).withColumn("table_name", F.lit(name)) for name, df in inputs]
    return materialize(parts[0].unionByName(parts[1]), "abuse")


def label_models(passed: DataFrame) -> dict[str, labelmodel.CorrelatedModel]:
    """The label model of each kind, on the vote patterns of all sentences of all records."""
    out = {}
    for kind, voters in VOTERS.items():
        rows = passed.where(F.col("part").isin("vote", "count")).groupBy(kind).agg(F.sum("n").alias("n")).collect()  # at most 2 ** voters
        trust = [0.0 if v == "context" else COMMON_TRUST if v in _COMMON or v == "target" else labelmodel.TRUST for v in voters]
        out[kind] = labelmodel.fit_correlated({r[kind]: r["n"] for r in rows}, trust)
    return out


def fit(passed: DataFrame, sample: int = SAMPLE) -> Classifier:
    """The label models on the patterns of all sentences, the classifier on a sample of them."""
    belief = {kind: model.posteriors for kind, model in label_models(passed).items()}
    drawn: dict[str, list[float]] = {}
    times: dict[str, int] = {}
    conditions = [F.col(k).isin([p for p, x in belief[k].items() if x >= 0.5] or ["none"]) for k in KINDS]
    anywhere = conditions[0] | conditions[1] | conditions[2]
    vote, spare, legit = (F.col("part") == part for part in ("vote", "spare", "against"))
    # Occurrences are drawn, not distinct sentences: what is frequent must not be missing.
    parts = [(c & vote, sample) for c in conditions]
    parts += [(~anywhere & vote, sample), (spare, 6 * sample), (legit, 4 * sample)]
    # A threshold on the hash first: the tasks together then send little more than the sample.
    voted = passed.where(vote | spare | legit)
    sizes = voted.agg(*[F.count_if(c).alias(f"n{i}") for i, (c, _) in enumerate(parts)]).first()
    for i, (condition, bound) in enumerate(parts):
        n = sizes[f"n{i}"]
        reach = int(2**32 * min(1.0, 1.2 * bound / n)) if n else 0
        for r in voted.where(condition & (F.col("h") < reach)).select("sentence", "part", "h", *KINDS).orderBy("h", "sentence").limit(bound).collect():
            drawn[r["sentence"]] = [0.0] * len(KINDS) if r["part"] != "vote" else [belief[k][r[k]] for k in KINDS]
            times[r["sentence"]] = times.get(r["sentence"], 0) + 1
    # A sentence drawn often counts up to four times.
    return train([item for item in sorted(drawn.items()) for _ in range(min(4, times[item[0]]))])


def record_scores(passed: DataFrame, model: Classifier) -> DataFrame:
    """table_name, record_id, source and the three scores of every record."""
    schema = "table_name string, record_id string, source string, abusive double, hateful double, sexual double"
    words = passed.where("part = 'words'").select("table_name", "record_id", "source", "words")
    return words.mapInArrow(_score(model), schema).groupBy("table_name", "record_id").agg(F.max("source").alias("source"), *[F.max(k).alias(k) for k in KINDS])


def flagged(scored: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """table_name, record_id, kind."""
    kinds = F.array(*[F.when(F.col(k) >= cutoff, F.lit(k)) for k in KINDS])
    return scored.select("table_name", "record_id", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("kind"))


def rates(scored: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Of each table and source: records, and the share flagged of each kind and of any."""
    hit = {k: F.col(k) >= cutoff for k in KINDS}
    share = lambda c: F.avg(c.cast("double"))
    return scored.groupBy("table_name", "source").agg(
        F.count(F.lit(1)).alias("n_records"), *[share(hit[k]).alias(f"{k}_rate") for k in KINDS],
        share(hit["abusive"] | hit["hateful"] | hit["sexual"]).alias("any_rate"),
    )


def against_review(scored: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """How the flags of reviewed documents stand to the reviewers' labels, by kind of label."""
    latest = labels.groupBy("doc_id").agg(F.max(F.struct("reviewed_at", "toxic", "kind")).alias("x")).select(
        F.col("doc_id").cast("string").alias("record_id"), F.col("x.toxic").alias("toxic"), F.coalesce("x.kind", F.lit("none")).alias("kind")
    )
    docs = scored.where(F.col("table_name") == "documents").withColumn("flagged", F.greatest(*KINDS) >= cutoff)
    return docs.join(latest, "record_id").groupBy("kind", "toxic").agg(F.count(F.lit(1)).alias("n_reviewed"), F.sum(F.col("flagged").cast("long")).alias("n_flagged"))
