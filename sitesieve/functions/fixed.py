"""Values that results depend on: word lists, patterns and limits. Patterns are read by Spark (through java()) and, where
a function works on spans, by Python; both see the same text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value) with the value computed once: a Column used many times in an expression is copied each time, and
    expressions built of such grow beyond what a plan can hold."""
    return F.element_at(F.transform(F.array(value), body), 1)


def java(pattern: str) -> str:
    """The pattern for Spark: without case, and with \\w, \\s and \\b for all scripts."""
    return f"(?iuU){pattern}"


# Domains of free mailboxes.
FREE_MAIL = """
mail.ru bk.ru inbox.ru list.ru internet.ru yandex.ru yandex.com yandex.by yandex.kz ya.ru rambler.ru lenta.ru ro.ru
autorambler.ru myrambler.ru e1.ru ngs.ru 126.com 163.com qq.com foxmail.com sina.com sina.cn sohu.com aliyun.com yeah.net
139.com 189.cn 21cn.com gmail.com googlemail.com yahoo.com ymail.com hotmail.com outlook.com live.com msn.com icloud.com
me.com mac.com aol.com gmx.com gmx.de proton.me protonmail.com zoho.com mail.com tutanota.com yahoo.co.jp
""".split()
# Suffixes of two labels.
TWO_PART_SUFFIXES = """
com.cn net.cn org.cn gov.cn ac.cn com.hk com.tw com.ru net.ru org.ru msk.ru spb.ru com.ua co.uk org.uk co.jp co.kr com.tr
com.br com.au co.in com.kz com.by com.sg com.my co.il
""".split()
# Words of a company's name that say nothing of whose it is.
GENERIC_NAME_WORDS = """
co ltd llc inc corp corporation company group holding holdings gmbh plc jsc pjsc the and of limited ооо оао зао пао ао ип
тд нпо нпп гк группа компания компаний торговый дом холдинг и тк пк фирма intelligent intelligence technology technologies
tech science sciences machinery machine machines equipment precision heavy industry industrial industries tool tools cnc
cemented carbide supply supplies trading trade international manufacturing manufacturer factory metal metals steel press
engineering systems system solutions electric automation import export global china russia завод технологии технология
системы оборудование станки станкостроение инструмент инструменты промышленный промышленная машиностроение техника
производство снабжение поставка центр
""".split()
# Foldings of a rough sound key, in the order they apply to Latin spelling.
SQUASH = [("tech", "teh"), ("kh", "h"), ("ph", "f"), ("ck", "k"), ("qu", "kv"), ("x", "ks"), ("w", "v"), ("y", "i")]
# Directories, networks and marketplaces, which are no company's own site.
AGGREGATORS = """
2gis.ru yandex.ru google.com google.ru hh.ru rusprofile.ru zoon.ru wikipedia.org avito.ru vk.com vk.ru ok.ru t.me
telegram.org youtube.com rutube.ru linkedin.com facebook.com instagram.com twitter.com x.com whatsapp.com wa.me tiktok.com
list-org.com sbis.ru checko.ru orgpage.ru yell.ru flamp.ru tiu.ru satom.ru pulscen.ru blizko.ru all.biz spark-interfax.ru
kontur.ru habr.com vc.ru dzen.ru export-base.ru metaprom.ru rocketreach.co zoominfo.com apollo.io hunter.io lusha.com
contactout.com signalhire.com crunchbase.com companies.rbc.ru rbc.ru audit-it.ru zachestnyibiznes.ru vbankcenter.ru
synapsenet.ru b2b-center.ru fabrikant.ru prom.ru ru.all.biz yandex.com mail.ru ozon.ru wildberries.ru market.yandex.ru
tinkoff.ru expocentr.ru exponet.ru kompass.com europages.com alibaba.com made-in-china.com productcenter.ru fabricators.ru
manufacturers.ru oborudunion.ru equipnet.ru bizorg.su spravker.ru cataloxy.ru yp.ru rosfirm.ru ru-bezh.ru trudvsem.ru
superjob.ru
""".split()
# Suffixes under which each host is a site of its own.
SHARED_SUFFIXES = """
tilda.ws tilda.cc wixsite.com wix.com ucoz.ru ucoz.net ucoz.com ucoz.org ucoz.ua 3dn.ru my1.ru at.ua clan.su narod.ru
narod2.ru github.io gitlab.io blogspot.com blogspot.ru wordpress.com webflow.io tb.ru nethouse.ru umi.ru jimdo.com
jimdofree.com weebly.com squarespace.com netlify.app vercel.app pages.dev herokuapp.com web.app firebaseapp.com
appspot.com azurewebsites.net myshopify.com myinsales.ru turbo.site bitrix24.site bitrix24site.ru bitrix24.shop
lpmotor.ru flexbe.net flexbe.com tobiz.net nubex.ru setup.ru okis.ru usite.pro mya5.ru tiu.ru satom.ru pulscen.ru deal.by
prom.ua business.site google.com sites.google.com vk.com com.ru net.ru org.ru pp.ru ac.ru edu.ru gov.ru int.ru mil.ru
msk.ru spb.ru msk.su spb.su nov.su adygeya.ru altai.ru amur.ru arkhangelsk.ru astrakhan.ru bashkiria.ru belgorod.ru bir.ru
bryansk.ru buryatia.ru cbg.ru chel.ru chelyabinsk.ru chita.ru chukotka.ru chuvashia.ru dagestan.ru dudinka.ru e-burg.ru
grozny.ru irkutsk.ru ivanovo.ru izhevsk.ru jar.ru joshkar-ola.ru kalmykia.ru kaluga.ru kamchatka.ru karelia.ru kazan.ru
kchr.ru kemerovo.ru khabarovsk.ru khakassia.ru khv.ru kirov.ru koenig.ru komi.ru kostroma.ru krasnoyarsk.ru kuban.ru
kurgan.ru kursk.ru lipetsk.ru magadan.ru mari.ru mari-el.ru marine.ru mordovia.ru murmansk.ru nalchik.ru nnov.ru nov.ru
novosibirsk.ru nsk.ru omsk.ru orenburg.ru oryol.ru palana.ru penza.ru perm.ru ptz.ru rnd.ru ryazan.ru sakhalin.ru
samara.ru saratov.ru simbirsk.ru smolensk.ru stavropol.ru stv.ru surgut.ru tambov.ru tatarstan.ru tom.ru tomsk.ru
tsaritsyn.ru tsk.ru tula.ru tuva.ru tver.ru tyumen.ru udm.ru udmurtia.ru ulan-ude.ru vladikavkaz.ru vladimir.ru
vladivostok.ru volgograd.ru vologda.ru voronezh.ru vrn.ru vyatka.ru yakutia.ru yamal.ru yaroslavl.ru yekaterinburg.ru
yuzhno-sakhalinsk.ru com.cn net.cn org.cn com.hk com.tw com.ua co.uk org.uk co.jp co.kr com.tr com.br com.au co.in com.kz
com.by com.sg com.my co.il in.ua kiev.ua
""".split()

# Keys of robots lines, and byte-order marks as UTF-8, cp1251 and Latin-1 show them.
ROBOTS_KEYS = ("user-agent", "allow", "disallow", "sitemap", "crawl-delay", "host", "clean-param")
ROBOTS_MARKS = ("﻿", "п»ї", "ï»¿")

# Mailboxes.
EMAIL = r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,24}"
ROLE_MAILBOX = (
    r"^(info|sales?|office|zakaz|hello|contacts?|mail|export|market(ing)?|support|admin|opt|orders?|service|shop|post|reception|"
    r"inquiry|enquiry|trade|commerce|import|dealer|partner)[\d._-]*$"
)
GENERIC_WORDS = (
    r"info|inform|mail|e?-?mail|office|ofis|post|pochta|hello|hi|contacts?|kontakt\w*|welcome|admin\w*|webmaster|support|help|"
    r"helpdesk|service|servis|sales?|sell|prodaj\w*|prodazh\w*|opt|optom|zakaz\w*|orders?|shop|store|market|marketing|reklama|"
    r"pr|press|media|smm|hr|jobs?|career|rabota|resume|personal|kadry|ok|op|buh\w*|bux|account\w*|fin|finance|zakupki|zakup|"
    r"snab|supply|tenders?|tendery|export|import|ved|dealers?|diler\w*|partners?|clients?|klient\w*|customers?|managers?|team|"
    r"company|corp|reception|priem\w*|secretar\w*|sekretar\w*|kanc\w*|fax|sbyt|sbt|torg|trade|commerce|commercial|"
    r"kommer[cs]\w*|komm?|logist\w*|sklad|dostavka|delivery|transport|tech|it|no-?reply|robot|bot|feedback|request|zapros|"
    r"zayavka|leads?|crm|site|web|www|news|subscribe|pay|bill\w*|legal|law|urist|expo|edu|school|academy|moscow|msk|spb|piter|"
    r"regions?|filial|ekb|nsk|kzn|central|volga|north|south|sib|ural|zavod|factory|plant|lab|b2b|1c|general|common|all|group|"
    r"otdel\w*|department|dept|zapchasti|parts|project\w*|kp|cp"
)
ROLE_WORDS = (
    r"dir|director|direktor|gendir|gen-?dir|gd|ceo|cco|cmo|cbdo|cro|kd|komdir|comdir|commdir|kommdir|head|boss|chief|president|"
    r"owner|founder|upr|zamdir|zam|md"
)
JUNK_EMAIL = r"\.(?:png|jpe?g|gif|svg|webp|js|css)$|@(?:example\.|domain\.|sentry|wixpress|email\.|test\.)|^(?:name|email|user|username|your|you)@"
SPLIT_ZONE = r"(?<![\w.+-])([a-z0-9][a-z0-9._%+-]{0,39}@[a-z0-9-]+(?:\.[a-z0-9-]+)*)\s+\.\s?([a-z]{2,10})(?![\w-])"
OBFUSCATED = (
    r"(?<![\w.+-])([a-z0-9][a-z0-9._%+-]{0,39})\s*"
    r"(?:\[\s*(?:at|собака|@)\s*\]|\(\s*(?:at|собака|@)\s*\)|\{\s*(?:at|собака|@)\s*\})\s*"
    r"([a-z0-9-]+(?:(?:\.|\s*\[\s*(?:dot|точка)\s*\]\s*|\s*\(\s*(?:dot|точка)\s*\)\s*)[a-z0-9-]+){1,3})(?![\w-])"
)
SPELLED_DOT = r"\s*(?:\[\s*(?:dot|точка)\s*\]|\(\s*(?:dot|точка)\s*\)|\.)\s*"
# Phone numbers.
PHONE = r"(?<!\d)(?:\+7|8)[\s (\-]*\d{3,5}[\s )\-]*\d{1,3}[\s \-]?\d{2}[\s \-]?\d{2,3}(?:\s*\(?(?:доб|вн|ext)\.?\s*\(?\d{2,5}\)?)?"
MOBILE = r"(?<![\d+])((?:\+\s?7|7|8)[\s (\-]{0,3})?(\(?9\d{2}\)?[\s \-]{0,3}\d{3}[\s \-]{0,2}\d{2}[\s \-]{0,2}\d{2})(?!\d)"
PHONE_EXTENSION = r"\s*\(?(?:доб|вн|ext)"
EXTENSION = r"(?<![\w-])(?:доб|внутр|вн|ext)\.?\s*[:№(]*\s*(\d{1,5})"

# Links of a homepage.
SEGMENT_END = r"(?:/|\.s?html?|\.php|\.aspx?|$)"
ABOUT_TEXT = (
    r"^\s*(?:о\s+(?:компании|нас|заводе|предприятии|фирме)|история|about|company\s+profile|who\s+we\s+are|our\s+story)(?![^\W_])[^|]{0,30}$|"
    r"^\s*(?:company|компания|profile)\s*$|^\s*(?:关于|公司简介|企业简介|简介|公司介绍)[^|]{0,12}$"
)
ABOUT_PATH = (
    r"(?:^|/)(?:about(?:[-_]?us)?|about[-_]company|o[-_]?kompanii|o[-_]nas|o[-_]zavode|o[-_]predpriyatii|kompaniya|"
    r"company(?:[-_]profile)?|profile|history|istoriya|who[-_]we[-_]are|our[-_]story|guanyu(?:women)?|gywm|jianjie)" + SEGMENT_END
)
NEWS_TEXT = (
    r"^\s*(?:новости|новость|news|пресс-?центр|пресс-?релиз\w*|press(?:\s+(?:releases?|cent(?:er|re)|room))?|события|блог|blog|"
    r"обновлени\w*|updates?|релизы|releases?|что\s+нового|what'?s\s+new|changelog|кейсы|cases?|case\s+studies)(?![^\W_])[^|]{0,30}$|"
    r"^\s*(?:新闻|动态|资讯|公司新闻|企业新闻)[^|]{0,12}$"
)
NEWS_PATH = (
    r"(?:^|/)(?:news|novosti|novost|newsroom|news[-_]?(?:list|cent(?:er|re))|press|pressroom|press[-_]?(?:cent(?:er|re)|room|releases?)|"
    r"press[-_]?tsentr|blog|updates|releases|changelog|whats[-_]?new|sobytiya|events|cases|case[-_]studies|keysy|kejsy|keisy|xinwen)" + SEGMENT_END
)
CASES = r"кейс|case|keys|kejs|keis"
SKIPPED_FILES = r"\.(pdf|jpe?g|png|gif|webp|svg|zip|rar|7z|docx?|xlsx?|pptx?|mp4|avi|mov|mp3|exe)$"
CONTACT_PATH = r"/(contacts?|contact[-_]?us|contact[-_]information|kontakty?|kontakti|svyaz|lianxi)(\.html?|\.php)?/?$"
CONTACT_TEXT = r"^\s*(контакты|контакт|contacts?|contact us|связаться с нами|联系我们)\s*$"
# Kinds of pages with their weight, a pattern of the path and one of the anchor.
PAGE_KINDS = [
    ("contacts", 10, r"(?:^|/)(?:contacts?|contact[-_]?us|kontakty?i?|kontakti|kontaktnaya[-_]informatsiya\w*|svyaz\w*)" + SEGMENT_END,
     r"^\s*(?:контакты|контактная информация|contacts?|contact us|связаться с нами|наши контакты)\s*$"),
    ("team", 9, r"(?:^|/)(?:team|our[-_]team|komanda|nasha[-_]komanda|staff|sotrudniki|nashi[-_]sotrudniki|rukovodstvo|rukovoditeli|management|managment|leadership|"
     r"people|persons?|kollektiv|administra[ct]i[yj]a|administration|employees|experts?|specialists?|specialisty)" + SEGMENT_END,
     r"^\s*(?:(?:наша\s+)?команда|(?:наши\s+)?сотрудники|руководство(?:\s+компании)?|руководители|менеджмент|коллектив|администрация|наши\s+специалисты|team|our team|"
     r"management|leadership|people)\s*$"),
    ("dept", 7, r"(?:^|/)(?:otdel[-_]prodazh|sales|sbyt|commercial|kommercheskij[-_]otdel)" + SEGMENT_END,
     r"^\s*(?:отдел продаж|отдел сбыта|коммерческий отдел|служба продаж|коммерческая служба)\s*$"),
    ("about", 6, r"(?:^|/)(?:about(?:[-_]?us)?|about[-_]company|o[-_]?kompanii|o[-_]nas|company|kompaniya|o[-_]zavode|o[-_]predpriyatii|press/contact)" + SEGMENT_END,
     r"^\s*(?:о компании|о нас|компания|о заводе|о предприятии|about|about us|company)\s*$"),
    ("press", 5, r"(?:^|/)(?:press|press[-_]?(?:cent(?:er|re)|room|kit|sluzhba)|pressa|dlya[-_]smi|smi|media)" + SEGMENT_END,
     r"^\s*(?:пресс-центр|пресс-служба|прессе|для сми|сми|для прессы|press|media|press kit)\s*$"),
]
NOT_FOUND = r"\b404\b|не\s+найден|not\s+found|page\s+missing"
PLACEHOLDER = (
    r"welcome to nginx|the nginx web server is successfully installed|apache2? \w* ?default page|"
    r"<title>\s*(?:it works!?|index of /|default web site page|domain (?:is )?parked)|this domain is (?:parked|for sale)|домен (?:припаркован|продается|продаётся)"
)
GENERIC_TITLE = r"^(главная( страница)?|home( ?page)?|index|главная|официальный сайт|welcome|о компании|about( us)?|新闻资讯|首页|关于我们)$"

# Tags.
BLOCKS = frozenset(
    "p div li ul ol h1 h2 h3 h4 h5 h6 tr td th section article header footer nav aside main table dd dt blockquote figcaption address br hr form label option title".split()
)
MORE_BLOCKS = BLOCKS | frozenset("dl tbody thead tfoot figure details summary body html".split())
UNSEEN = frozenset("script style noscript svg template iframe canvas".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
PAGE_CHROME = frozenset("nav header footer form aside".split())
SITE_CHROME = frozenset("header footer nav".split())
CONTENT = frozenset("main article section".split())

# Lines of a page.
BOILERPLATE = (
    r"cookie|куки|javascript|браузер|browser|все права|all rights|конфиденциальн|privacy|подпис(ать|ка)|subscribe|корзин|\bcart\b|войти|log ?in|sign ?in|регистрац|"
    r"©|copyright|\+7|\+86|тел\.|tel:|e-?mail|whatsapp|wechat|telegram"
)
FACT_HINT = (
    r"\b(19|20)\d{2}\b|\d+\s*(лет|год|стран|сотрудник|клиент|проект|филиал|м2|м²|тонн|единиц|years|countries|employees|clients|customers|projects|square)|"
    r"основан|since|founded|established|производ|manufactur|специализ|speciali|поставля|supplier|завод|factory|plant|разрабат|develop|экспорт|export|сертифик|certif"
)
GENERIC_FACT = (
    r"доставк\w*\s+(?:и\s+самовывоз\w*\s+)?по\s+(?:всей\s+)?(?:россии|рф|стране|миру)|самовывоз|"
    r"(?:звон\w*|консультир\w*|работаем|принимаем\s+заказы)[^.]{0,40}(?:ежедневно|круглосуточно|без\s+выходных|до\s+\d{1,2}[:.]\d{2})|"
    r"(?:участник|резидент)\w*\s+\W?сколково|оптов\w*\s+цен\w*|цен\w*\s+от\s+\d|скидк\w*|выгодн\w*\s+(?:цен|услов)|индивидуальн\w*\s+подход|гарант\w*\s+качеств|"
    r"высок\w*\s+качеств|бесплатн\w*\s+(?:доставк|консультац)|(?:на\s+рынке|работаем)\s+с\s+(?:19|20)\d{2}|(?<![^\W\d_])с\s+(?:19|20)\d{2}\s+года|"
    r"лет\s+(?:на\s+рынке|опыта)|years\s+of\s+experience|high\s+quality|best\s+price|competitive\s+price|free\s+shipping|one-stop"
)
TRIVIAL_NEWS = (
    r"поздрав|с\s+новым\s+годом|с\s+наступающ|праздни|8\s+марта|23\s+февраля|9\s+мая|график\s+работы|режим\s+работы|выходн\w+\s+дн|изменени\w*\s+(?:цен|график)|"
    r"повышени\w*\s+цен|технически\w+\s+работ|holiday|new\s+year|christmas|national\s+day|spring\s+festival|春节|放假|国庆"
)
OPENING_HOURS = (
    r"работа\w*\s+(?:в|по)\s+(?:суббот|воскресен|выходн|праздн)|(?:час\w*|график\w*|режим\w*)\s+работы|\d{1,2}[:.]\d{2}\s*(?:до|[-–—])\s*\d{1,2}[:.]\d{2}"
)
RELATIVE_TIME = (
    r"в\s+(?:этом|текущем|прошлом|минувшем)\s+(?:году|месяце|сезоне)|недавн\w*|на\s+днях|только\s+что|\bтеперь\b|(?:этой|прошлой)\s+(?:весной|осенью|зимой)|"
    r"(?:этим|прошлым)\s+летом|в\s+этом\s+квартале"
)
OPENING = r"^Увидели(?:\s+[^,.!?]{1,40})?,\s+что\s"
PRAISE = r"впечатл|восхищ|потрясающ|замечательн|великолепн|прекрасн|невероятн|вдохновля|восторг|отличн|круто|здорово|респект|поздравля|молодц"
NO_DATA = "нет данных"
CJK = r"[　-〿㐀-䶿一-鿿＀-￯]"
ENTRY_META = r"читать|\bмин\b|минут|просмотр|коммент|автор|\bviews?\b|\bread\b|\bmin\b"
HERO_LINES, STALE_DAYS, MOST_CHARS, MOST_WORDS = 4, 365, 240, 30

# Dates in text, in the order in which they claim it.
RU_MONTHS = [("январ", 1), ("феврал", 2), ("март", 3), ("апрел", 4), ("ма", 5), ("июн", 6), ("июл", 7), ("август", 8), ("сентябр", 9), ("октябр", 10), ("ноябр", 11), ("декабр", 12)]
EN_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
RU_MONTH = r"(январ[ьяе]|феврал[ьяе]|марта?|марте|апрел[ьяе]|ма[йяе]|июн[ьяе]|июл[ьяе]|августа?|августе|сентябр[ьяе]|октябр[ьяе]|ноябр[ьяе]|декабр[ьяе])"
EN_MONTH = r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"
SEASONS = [("весн", 4), ("лет", 7), ("осен", 10), ("зим", 1)]
YEAR = r"((?:19|20)\d{2})"
DATES = [
    ("dmy", r"(?<!\d)(\d{1,2})[./](\d{1,2})[./]" + YEAR + r"(?!\d)"),
    ("ymd", r"(?<!\d)" + YEAR + r"[-./](\d{1,2})[-./](\d{1,2})(?!\d)"),
    ("dMy", r"(?<!\d)(\d{1,2})\s+" + RU_MONTH + r"\s+" + YEAR),
    ("My", r"(?<![^\W\d_])" + RU_MONTH + r"\s+" + YEAR),
    ("dMy", r"(?<!\d)(\d{1,2})\s+" + EN_MONTH + r"\s+" + YEAR),
    ("Mdy", r"\b" + EN_MONTH + r"\s+(\d{1,2}),?\s+" + YEAR),
    ("My", r"\b" + EN_MONTH + r"\s+" + YEAR),
    ("ymd", YEAR + r"年(\d{1,2})月(?:(\d{1,2})日)?"),
    ("Sy", r"(?<![^\W\d_])(весн[аеойу]|лет[аоме]м?|осен[ьюи]|зим[аеойу])\s+" + YEAR),
]
UPDATED = (
    r"(?:обновлен[оаы]?|дата\s+(?:обновления|изменения)|последнее\s+(?:обновление|изменение)|актуальн\w+\s+на|last\s+(?:updated|modified)|updated(?:\s+on)?)\s*:?\s*"
)
COPYRIGHT_YEAR = r"(?:©|\(c\)|copyright)[^\n]{0,40}?((?:19|20)\d{2})(?:\s*[-–—]\s*((?:19|20)\d{2}))?"
STAFF_COUNT = (
    r"(?<![\d.,])(\d{1,3}(?:[\s ]?\d{3})?)\s*\+?\s*(?:[а-яё-]+(?:ых|их)\s+){0,2}(?:сотрудник|специалист|человек\s+в\s+(?:штате|команде)|работник|employees)"
)
PERSONAL_DATA_BAN = (
    r"запрет\w*\s+на\s+обработку[^.]{0,160}(?:неограниченным\s+кругом|персональн\w+\s+данн)|"
    r"запрещ\w+\s+(?:сбор|обработк\w+|использовани\w+)\s+(?:опубликованных\s+)?персональн\w+\s+данн"
)
REFUSAL = (
    r"(?:рекламн\w+|коммерческ\w+)\s+предложени\w+\s+(?:не\s+(?:рассматрива|принима)|просим\s+не)|"
    r"не\s+(?:присылайте|направляйте|отправляйте|присылать|направлять|отправлять)\s+(?:нам\s+)?(?:рекламн|коммерческ\w+\s+предлож|спам)|"
    r"неинтересующ\w+\s+предложени|предложени\w+\s+(?:рекламы|рекламного\s+характера)\s+не\s+(?:рассматрива|принима)"
)
FOREIGN_SECTION = (
    r"отзыв|благодарност|рекомендац|наши\s+клиенты|клиенты\s+о\s+нас|говорят\s+клиенты|партн[её]ры|нам\s+доверяют|об\s+авторе|автор\s+стать|testimonial|reviews?|"
    r"our\s+clients|partners"
)
FOREIGN_PATH = (
    r"(?:^|/)(?:authors?|avtor\w*|blog|articles?|stati|news|novosti|otzyv\w*|reviews?|testimonials?|clients?|klienty|partners?|partnery|cases?|kejsy|portfolio)(?:/|$)"
)
ORGANISATION = (
    r"(?:ооо|ао|зао|оао|пао|ип|гк|нпо|нпп|тд|компании|фирмы|группы\s+компаний|холдинга|завода|банка|агентства)\s+[«\"“]?([^»\"”,.;:()]{2,60})"
)

# Titles and roles.
MODIFIER = (
    r"(?:генеральн\w+|ген\.|коммерческ\w+|ком\.|исполнительн\w+|управляющ\w+|техническ\w+|финансов\w+|операционн\w+|региональн\w+|главн\w+|ведущ\w+|старш\w+|младш\w+|"
    r"перв\w+|заместител\w+|зам\.|и\.\s?о\.|врио|креативн\w+|managing|general|commercial|executive|chief|senior|regional|deputy|vice)"
)
HEAD = (
    r"(?:гендиректор\w*|директор\w*|руководител\w+|начальник\w*|глав[аы]|заместител\w+|менеджер\w*|специалист\w*|бухгалтер\w*|инженер\w*|владел[еь]\w+|собственник\w*|"
    r"(?:со)?основател\w+|учредител\w+|партн[её]р\w*|президент\w*|управляющ\w+|председател\w+|секретар\w+|помощни\w+|ассистент\w*|юрист\w*|консультант\w*|аналитик\w*|"
    r"маркетолог\w*|логист\w*|экономист\w*|преподавател\w+|эксперт\w*|координатор\w*|администратор\w*|представител\w+|конструктор\w*|технолог\w*|диспетчер\w*|"
    r"оператор\w*|программист\w*|разработчик\w*|дизайнер\w*|ceo|cco|cmo|coo|cfo|cto|cio|cbdo|cro|co-?founder|founder|owner|president|director|manager|head\s+of|vp|"
    r"partner|chief\s+\w+\s+officer)"
)
TITLE_START = rf"(?<![\w-])(?:{MODIFIER}\s+){{0,3}}{HEAD}(?![\w-])"
TITLE_STOP = (
    r"[;:!?|•]|\.(?=[\s»\"”]*[A-ZА-ЯЁ\d]|[\s»\"”]*$)|\s[-–—]\s+(?=[A-ZА-ЯЁ])|\+?\d[\d\s()\-]{6,}|"
    r"(?<![\w-])(?i:тел(?:ефон)?|моб|e-?mail|email|почта|эл\.|доб|факс|skype|whatsapp|telegram|профиль)(?![\w-])"
)
OBLIQUE_HEAD = (
    r"(?:главы|(?:директор|руководител|начальник|управляющ|президент|председател|владельц|основател|учредител|собственник|менеджер|специалист|инженер|бухгалтер|юрист|"
    r"консультант|аналитик|маркетолог|логист|экономист|эксперт|координатор|администратор|представител|конструктор|технолог|диспетчер|оператор|программист|разработчик|"
    r"дизайнер|партн[её]р)(?:а|я|у|ю|ом|ем|ём|е|ов|ей|ам|ям|ами|ями|ах|ях|его|ему|им))$"
)
PLURAL_HEAD = r"(?:[ыи]|ors|ers)$"
DEPUTY = r"заместител|\bзам\.|deputy|\bvice\b|вице-|и\.\s?о\.|врио"
GENERIC_HEAD_TITLE = r"^(?:начальник|руководитель|глава|директор)\s+(?:отдела|департамента|службы|управления|группы|направления|подразделения|дирекции)$"
DEPARTMENT = (
    r"^(?:(?:[а-яё-]+(?:ый|ий|ой|ая|яя|ое)\s+)?(?:отдел|департамент|служба|управление|дирекция)|бухгалтерия|при[её]мная|секретариат|канцелярия|техподдержка|"
    r"техническая поддержка|склад|производство|подразделение)(?![\w-])"
)
TARGET_HEAD = r"(?:директор|руководител|начальник|глава|head|director|chief|vp|vice president|заместител|зам\.)"
ROLES = [
    ("commercial", r"коммерческ\w+\s+директор|ком\.\s*директор|директор\w*\s+по\s+коммерц|по\s+коммерческ|(?:руководител|начальник|глава)\w*\s+коммерческ|\bcco\b|"
     r"chief commercial|commercial director|head of commercial"),
    ("sales", rf"{TARGET_HEAD}[^,;]*?(?:продаж|сбыт|реализаци|sales|корпоративн\w+\s+(?:отдел|клиент))|\bcro\b|chief (?:sales|revenue)"),
    ("marketing", rf"{TARGET_HEAD}[^,;]*?маркетинг|\bcmo\b|chief marketing|marketing director|head of marketing"),
    ("bizdev", rf"{TARGET_HEAD}[^,;]*?(?:развити|клиент|партн[её]рск|стратег)|business development|\bcbdo\b"),
]
NOT_A_HEAD = r"менеджер|специалист|представител"
STAFF_START = (
    r"^(?:(?:ведущ\w+|старш\w+|младш\w+|главн\w+|региональн\w+|персональн\w+|личн\w+)\s+)?(?:помощни|ассистент|секретар|референт|советник|водител|стаж[её]р|менеджер|"
    r"специалист|бухгалтер|инженер|юрист|консультант|аналитик|маркетолог|логист|экономист|преподавател|эксперт|координатор|администратор|представител|конструктор|"
    r"технолог|диспетчер|оператор|программист|разработчик|дизайнер|manager|assistant|engineer|specialist|accountant|consultant)"
)
OTHER_FUNCTION = (
    r"по\s+(?:производств|качеств|персонал|кадр|финанс|экономик|безопасност|закупк|снабжени|логистик|ит\b|информацион|правов|юридическ|общим|строительств|наук|научн|"
    r"техническ|эксплуатац|сервис|охране|административ|хозяйств|учебн|проект|разработк|внедрени|операционн)|техническ\w+\s+директор|финансов\w+\s+директор|"
    r"операционн\w+\s+директор|(?:ит|it|арт|hr)-директор|креативн\w+\s+директор|\b(?:cfo|cto|cio|coo)\b"
)
CHIEF = (
    r"генеральн\w+\s+директор|ген\.\s*директор|гендиректор|исполнительн\w+\s+директор|управляющ\w+\s+(?:директор|партн[её]р)|^управляющ\w+$|^директор$|"
    r"^директор\s+(?:компании|предприятия|завода|фирмы|организации|ооо|ао|зао|оао|пао|ип|студии|агентства|бюро|группы)|владел|собственник|основател|учредител|^президент|"
    r"председател\w+\s+(?:правления|совета)|руководител\w+\s+(?:компании|предприятия|организации|фирмы|студии|агентства|бюро|завода)|\bceo\b|chief executive|"
    r"managing (?:director|partner)|founder|\bowner\b|^president|general (?:director|manager)|^директор\s*[«\"(]"
)
BRANCH = (
    r"региональн\w+\s+(?:директор|руководител|управляющ)|(?:директор|руководител|управляющ|глава|начальник)\w*\s+(?:[а-яё-]+\s+)?(?:филиал|представительств|"
    r"обособленн\w+\s+подразделени|регионального\s+(?:офиса|центра|отделения))|regional (?:director|manager|head)|branch (?:director|manager|head)"
)
DEPARTMENT_HEAD = (
    r"(?:руководител|начальник|глава|head)\w*\s+.*?(?:отдел|департамент|служб|групп|управлени|направлени|дирекци|центр|практик|подразделени)|head of"
)
ANY_DIRECTOR = r"директор|director|партн[её]р|partner|президент|председател"

# Names.
SURNAME_SUFFIX = r"(?:[оеё]в|[иы]н|[оеё]ва|[иы]на|ск(?:ий|ая|ой)|цк(?:ий|ая|ой)|ко|[ую]к|ич|[ыи]х|ян|дзе|швили)$"
PATRONYMIC = r"(?:ович|евич|ьич|овна|евна|ична|инична)$"
SHORT_PATRONYMICS = frozenset("ильич кузьмич лукич фомич никитич саввич ильинична кузьминична".split())
WORD_BEFORE_NAME = r"(?:^|[\s(«\"])(?:в|во|на|к|ко|с|со|от|у|для|из|по|о|об|при|за|что|как|где)\s+$"
STREET_BEFORE = r"(?:ул\.|улица|пр\.|пр-т|просп\.|проспект|пер\.|имени|им\.|пл\.|наб\.|б-р|бульвар|шоссе|проезд)\s*$"
INITIAL_LETTERS = {
    "а": "a", "б": "b", "в": "vw", "г": "gh", "д": "d", "е": "ey", "ё": "ey", "ж": "zjg", "з": "z", "и": "i", "й": "yji", "к": "kc", "л": "l", "м": "m", "н": "n", "о": "o",
    "п": "p", "р": "r", "с": "sc", "т": "t", "у": "uy", "ф": "fp", "х": "khx", "ц": "tc", "ч": "c", "ш": "s", "щ": "s", "э": "e", "ю": "yuj", "я": "yjia",
}
