"""Template residue and error-page text: TF-IDF containment of passage windows in labelled exemplars."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import bounded_broadcast, is_small, materialize, ship_package, table
from . import boilerplate

#: A window is residue from this containment; a record is a case from this share of its text.
CONTAINMENT, COVERAGE = 0.72, 0.3

# Labelled exemplars of residue, as language|kind|text. Numbers, hosts and codes are left out.
EXEMPLARS = """
en|script|Please enable JavaScript to view this page. Turn on JavaScript and reload. You need to enable JavaScript to run this app. JavaScript is required. JavaScript must be enabled to continue. This site requires JavaScript.
en|script|JavaScript is disabled in your browser. Some parts of this site will not load. This page will not work without JavaScript. Your browser does not support JavaScript.
en|script|This site requires scripts and cookies. Turn them on in your browser settings and reload. Please enable cookies to continue. Cookies are disabled. Please allow scripts and try again.
en|script|Loading… Please wait while the page loads. If nothing happens, your browser may be blocking scripts. If you are not redirected, click here.
en|browser|Your browser is out of date or not supported. Your browser is out of date and cannot display this site. Please upgrade to continue. Please update your browser. This browser is no longer supported.
en|check|Checking your browser before accessing. This process is automatic. Please allow a few seconds. Your browser will redirect to your requested content shortly. Ray ID
en|check|Verify you are human by completing the action below. The site needs to review the security of your connection. Verifying you are human. This may take a few seconds. Just a moment
en|check|Please complete the captcha to continue. Unusual traffic from your network. Are you a robot? Please confirm that you are not a robot. Press and hold the button.
en|missing|Page not found. The page you were looking for may have moved or been deleted. Return to the home page. The page you requested could not be found. This page does not exist. The link may be broken.
en|missing|Oops! We can't seem to find that story. Try searching instead. Nothing was found here. Sorry, this content is no longer available. This article has been removed.
en|missing|Not Found The requested URL was not found on this server.
en|server|Bad Gateway proxy nginx. Gateway timeout. Service unavailable. The server is temporarily unable to handle your request. The server returned an invalid response.
en|server|Internal server error. Internal error: upstream connect timeout after ms (trace). The request timed out. Connection refused. Empty response from server.
en|server|Sorry, something went wrong on our end (error). Please try again later. Reference: Oops, something went wrong. We are working on it. Unexpected error. Unknown error.
en|server|An error occurred while processing your request. Reference. An error has occurred. Please refresh the page.
en|limit|Too many requests. Please slow down and retry after seconds. Rate limit exceeded.
en|denied|Access Denied. You don't have permission to access this page on this server. Reference. You are not authorized to view this page. Access to this resource is restricted.
en|denied|Forbidden. Your request was blocked. The request was blocked by the security service. Your IP address has been blocked.
en|session|Your session has expired. Please log in again to continue. You must be logged in to view this page. Please sign in to continue.
en|region|This content is not available in your region. This video is unavailable. This content is not available in your country.
en|upkeep|We are down for scheduled maintenance and will be back at. This site is temporarily unavailable. The site is under maintenance. Please check back soon. Coming soon. Under construction.
en|program|Error establishing a database connection
en|program|Fatal error: uncaught exception in on line. Stack trace. Warning: undefined variable in on line. Notice: undefined index in on line. Parse error: syntax error
en|program|Traceback (most recent call last): File line in TypeError ValueError KeyError AttributeError object has no attribute render view. NullPointerException at java lang. Segmentation fault
en|filler|Sample text goes here. Replace it with your own. Your text here. Insert text here. Text goes here. Add your text. Type something. Click to edit. Enter text here.
en|filler|Headline goes here. Subhead goes here. Body copy to come (TK). Caption goes here. Title goes here. Enter title here. Insert headline here. Insert summary here. Insert caption here. Image caption. Author name here.
en|filler|This is placeholder text for the story body. Insert a lead of about words. This is a sample page. This is dummy text. Placeholder text. Lead paragraph goes here.
en|filler|TODO: write copy. Copy TK. Headline TK. TBD. To be announced. Draft, do not publish. Do not publish. Test article, please ignore. Test post. This is a test. Hello world. Content coming soon.
la|filler|Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum
de|script|Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen. Für diese Seite wird JavaScript benötigt. JavaScript ist deaktiviert. Diese Anwendung benötigt JavaScript. Ihr Browser unterstützt kein JavaScript. Ihr Browser unterstützt keine Skripte.
de|script|Ihr Browser blockiert Skripte; der Inhalt kann nicht geladen werden. Diese Seite benötigt JavaScript und Cookies. Bitte laden Sie die Seite neu. Bitte aktivieren Sie Cookies.
de|browser|Ihr Browser ist veraltet. Bitte aktualisieren Sie Ihren Browser. Ihr Browser wird nicht unterstützt.
de|check|Bitte bestätigen Sie, dass Sie kein Roboter sind. Ihr Browser wird überprüft. Einen Moment bitte. Sicherheitsüberprüfung.
de|missing|Seite nicht gefunden. Die angeforderte Adresse existiert nicht mehr. Zurück zur Startseite. Die angeforderte Seite wurde nicht gefunden. Dieser Inhalt ist nicht mehr verfügbar.
de|denied|Ihre Anfrage wurde blockiert. Zugriff verweigert. Vorgang. Sie haben keine Berechtigung, diese Seite aufzurufen. Dieser Inhalt ist in Ihrem Land nicht verfügbar.
de|server|Ein Fehler ist aufgetreten. Bitte versuchen Sie es später erneut. Bitte versuchen Sie es in Minuten erneut. Fehlercode. Interner Serverfehler. Es ist ein unerwarteter Fehler aufgetreten. Die Seite konnte nicht geladen werden.
de|limit|Zu viele Anfragen. Der Dienst ist vorübergehend nicht verfügbar. Wartungsarbeiten. Wegen Wartungsarbeiten nicht erreichbar.
de|session|Ihre Sitzung ist abgelaufen. Bitte melden Sie sich erneut an. Bitte melden Sie sich an, um fortzufahren.
de|filler|Hier steht der Titel. Dies ist ein Blindtext, bitte ersetzen. Platzhaltertext für den Vorspann. Hier steht der Text. Hier Text einfügen. Überschrift hier einfügen. Text folgt. Beispieltext. Platzhalter.
de|filler|Testartikel, bitte ignorieren. Testbeitrag. Bitte nicht veröffentlichen. Entwurf. Das ist ein Test.
fr|script|Veuillez activer JavaScript pour afficher cette page. Cette application nécessite l’exécution de scripts. JavaScript est désactivé. JavaScript est nécessaire. Votre navigateur ne prend pas en charge les scripts. Activez JavaScript et rechargez la page.
fr|script|Votre navigateur bloque les scripts ; le contenu ne peut pas être chargé. Veuillez activer les cookies. Rechargez la page.
fr|browser|Votre navigateur est obsolète. Veuillez mettre à jour votre navigateur. Votre navigateur n’est pas pris en charge.
fr|check|Veuillez confirmer que vous n’êtes pas un robot. Vérification de votre navigateur. Un instant. Vérification de sécurité.
fr|missing|Page introuvable (erreur). Le lien est peut-être périmé. Retour à l’accueil. La page demandée n’existe pas. Ce contenu n’est plus disponible. La page que vous cherchez est introuvable.
fr|denied|Votre requête a été bloquée. Accès refusé. Vous n’avez pas l’autorisation d’accéder à cette page. Ce contenu n’est pas disponible dans votre pays.
fr|server|Une erreur est survenue. Veuillez réessayer plus tard. Réessayez dans minutes. Référence. Erreur interne du serveur. Une erreur inattendue s’est produite.
fr|limit|Trop de requêtes. Service temporairement indisponible. Site en maintenance, merci de revenir dans minutes. Le site est en cours de maintenance.
fr|session|Votre session a expiré. Veuillez vous reconnecter. Veuillez vous connecter pour continuer.
fr|filler|Insérez ici le titre. Texte provisoire à remplacer. Texte de remplissage. Insérez votre texte ici. Votre texte ici. Titre à compléter. Texte à venir. Exemple de texte. Faux texte.
fr|filler|Article de test, merci d’ignorer. Ceci est un test. Brouillon, ne pas publier.
es|script|Active JavaScript para ver esta página. Habilite JavaScript en su navegador y recargue la página. Es necesario activar JavaScript. JavaScript está desactivado. Su navegador no admite JavaScript. Su navegador no admite scripts.
es|script|Esta aplicación necesita ejecutar scripts. Su navegador bloquea los scripts; no se puede cargar el contenido. Active las cookies.
es|browser|Su navegador está desactualizado. Actualice su navegador. Su navegador no es compatible.
es|check|Confirme que no es un robot. Comprobando su navegador. Un momento. Verificación de seguridad.
es|missing|Página no encontrada. Vuelva al inicio. El enlace puede haber caducado. La página solicitada no existe. La página que busca no existe. Este contenido ya no está disponible.
es|denied|Su solicitud ha sido bloqueada. Acceso denegado. No tiene permiso para acceder a esta página. Este contenido no está disponible en su país.
es|server|Se ha producido un error. Inténtelo de nuevo más tarde. Inténtelo de nuevo en minutos. Referencia. Error interno del servidor. Ha ocurrido un error inesperado. Algo salió mal.
es|limit|Demasiadas solicitudes. Servicio no disponible temporalmente. Sitio en mantenimiento. Estamos en mantenimiento.
es|session|Su sesión ha caducado. Inicie sesión de nuevo. Inicie sesión para continuar.
es|filler|Escriba aquí el título. Texto de relleno para sustituir. Texto de ejemplo. Inserte aquí el texto. Su texto aquí. Título provisional. Texto pendiente. Texto provisional.
es|filler|Artículo de prueba, por favor ignorar. Esto es una prueba. Borrador, no publicar.
pt|script|Ative o JavaScript para ver esta página. Habilite o JavaScript no navegador e recarregue a página. É necessário ativar o JavaScript. O JavaScript está desativado. Seu navegador não suporta JavaScript. Seu navegador não suporta scripts.
pt|script|Este aplicativo precisa executar scripts. Seu navegador está bloqueando scripts; o conteúdo não pode ser carregado. Ative os cookies.
pt|browser|Seu navegador está desatualizado. Atualize o seu navegador. Seu navegador não é compatível.
pt|check|Confirme que você não é um robô. Verificando seu navegador. Um momento. Verificação de segurança.
pt|missing|Página não encontrada. Volte ao início. O link pode ter expirado. A página solicitada não existe. A página que você procura não existe. Este conteúdo não está mais disponível.
pt|denied|Sua solicitação foi bloqueada. Acesso negado. Você não tem permissão para acessar esta página. Este conteúdo não está disponível no seu país.
pt|server|Ocorreu um erro. Tente novamente mais tarde. Tente novamente em minutos. Referência. Código. Erro interno do servidor. Ocorreu um erro inesperado. Algo deu errado.
pt|limit|Muitas solicitações. Serviço temporariamente indisponível. Site em manutenção. Estamos em manutenção.
pt|session|Sua sessão expirou. Entre novamente. Faça login para continuar.
pt|filler|Digite aqui o título. Texto provisório para substituir. Texto de exemplo. Insira o texto aqui. Seu texto aqui. Título provisório. Texto de preenchimento. Texto a definir.
pt|filler|Artigo de teste, favor ignorar. Isto é um teste. Rascunho, não publicar.
ru|script|Включите JavaScript, чтобы просмотреть эту страницу. Для работы сайта требуется JavaScript. JavaScript отключён. Ваш браузер не поддерживает JavaScript. Включите JavaScript и обновите страницу. Ваш браузер не поддерживает скрипты.
ru|script|Ваш браузер блокирует скрипты, содержимое не может быть загружено. Включите файлы cookie.
ru|browser|Ваш браузер устарел. Обновите браузер. Ваш браузер не поддерживается.
ru|check|Подтвердите, что вы не робот. Проверка браузера. Подождите немного. Введите символы с картинки.
ru|missing|Страница не найдена. Возможно, она была удалена. Вернитесь на главную. Запрошенная страница не существует. Материал больше не доступен. Ссылка устарела.
ru|denied|Ваш запрос заблокирован. Доступ запрещён. У вас нет прав для просмотра этой страницы. Материал недоступен в вашем регионе.
ru|server|Произошла ошибка. Повторите попытку позже. Код ошибки. Внутренняя ошибка сервера. Произошла непредвиденная ошибка. Что-то пошло не так. Попробуйте обновить страницу.
ru|limit|Сервис временно недоступен, повторите через минут. Слишком много запросов. Ведутся технические работы. Сайт на обслуживании.
ru|session|Сеанс истёк. Войдите снова. Войдите, чтобы продолжить. Срок действия сессии истёк.
ru|filler|Здесь будет заголовок. Текст-заглушка, замените его. Текст-заполнитель. Рыбный текст. Введите текст. Вставьте текст. Здесь будет текст. Пример текста. Введите заголовок.
ru|filler|Тестовая статья, не обращайте внимания. Это тест. Черновик, не публиковать.
zh|script|请开启JavaScript后重新加载页面。请启用JavaScript以查看此页面。您的浏览器不支持脚本，无法显示内容。您的浏览器已禁用JavaScript。需要启用JavaScript才能运行此应用。请启用Cookie。
zh|browser|您的浏览器版本过低，请升级浏览器。您的浏览器不受支持。
zh|check|访问过于频繁，请输入验证码后继续。当前环境异常，完成验证后即可继续访问。请完成安全验证。请确认您不是机器人。正在检查您的浏览器。
zh|missing|抱歉，您访问的页面不存在。请返回首页。页面未找到。您要查看的页面已被删除。找不到页面。链接已失效。
zh|server|系统繁忙，请稍后再试。错误编号。服务器内部错误。服务器错误。发生未知错误。加载失败，请刷新重试。网络异常，请重试。
zh|limit|服务暂时不可用，系统维护中，请稍后访问。网站正在维护。请求过于频繁。
zh|denied|您的请求已被拦截。拒绝访问。您没有权限访问此页面。该内容在您所在的地区不可用。
zh|session|登录已过期，请重新登录。请登录后查看。
zh|gone|请在微信客户端打开链接。该内容已被发布者删除。此内容因违规无法查看。
zh|filler|此处填写标题。此处填写正文内容。占位文字，请替换。在此输入文字。请输入标题。示例文本。此处为占位内容。
zh|filler|测试文章，请忽略。这是一个测试。草稿，请勿发布。
ja|script|JavaScriptを有効にしてからページを再読み込みしてください。お使いのブラウザーではスクリプトが無効です。コンテンツを表示できません。このページを表示するにはJavaScriptが必要です。JavaScriptが無効になっています。Cookieを有効にしてください。
ja|browser|お使いのブラウザは古いためこのサイトを表示できません。ブラウザを更新してください。お使いのブラウザはサポートされていません。
ja|check|ロボットではないことを確認してください。ブラウザを確認しています。しばらくお待ちください。
ja|missing|お探しのページは見つかりませんでした。ホームへ戻る。ページが見つかりません。このページは削除されたか移動しました。このコンテンツはご利用いただけません。
ja|server|エラーが発生しました。しばらくしてからもう一度お試しください。コード。サーバー内部エラー。予期しないエラーが発生しました。
ja|limit|アクセスが集中しています。分後に再度お試しください。ただいまメンテナンス中です。サービスは一時的に利用できません。
ja|denied|アクセスが拒否されました。リクエストはブロックされました。このページを表示する権限がありません。お住まいの地域ではご利用いただけません。
ja|session|セッションの有効期限が切れました。もう一度ログインしてください。続行するにはログインしてください。
ja|filler|ここにタイトルを入力。ここに本文が入ります。ダミーテキストです。差し替えてください。テキストを入力してください。サンプルテキスト。仮の文章です。
ja|filler|テスト記事です。無視してください。これはテストです。下書きのため公開しないでください。
"""

_NAME = r"[A-Za-z_][\w.\- ]{0,40}"
#: Template slots and raw program values that no finished text holds.
SLOT = re.compile(
    rf"\{{\{{\s*[^{{}}\n]{{1,60}}\}}\}}|[$#]\{{\s*{_NAME}\s*\}}|<%[=#]?\s*[^%\n]{{1,60}}%>|<\?=?\s*[^?\n]{{1,60}}\?>|\{{%\s*[^%\n]{{1,60}}%\}}|%%\s*{_NAME}\s*%%|\[%\s*{_NAME}\s*%\]"
    rf"|\[\[\s*{_NAME}\s*\]\]|\*\|\s*{_NAME}\s*\|\*|@@\s*{_NAME}\s*@@|(?<!\w)__[A-Za-z][\w.]*?__(?!\w)|\{{\s*[A-Za-z_][\w.]*\s*\}}|\{{\d\}}|\[object \w+\]|(?<![\w-])NaN(?![\w-])|%\(\w+\)[sd]"
)
#: Program values that are also words: residue where they interrupt a sentence of another kind.
VALUE = re.compile(r"(?<![\w-])undefined(?![\w-])|(?<![\w-])null(?![\w-])|\bnil\b|\(null\)")
_RUN = re.compile(r"(?:\b([xX])\1{2,}\b[\s.,]*){3,}|(?:\b(?:asdf|qwerty|blah|test)\b[\s.,]*){3,}", re.I)
#: What each of these patterns needs to be in a text: looked for before the pattern is.
_SLOT_SIGNS = ("{", "<%", "<?", "%%", "[%", "[[", "*|", "@@", "__", "[object", "NaN", "%(")
_RUN_SIGNS = ("xxx", "asdf", "qwerty", "blah", "test")
_VALUE_SIGNS = ("undefined", "null", "nil")
_NOISE = re.compile(r"\bhttp/[\d.]+|https?://\S+|\S+\.(?:example|com|org|net|html?|php|py|js)\b\S*|/\S+|#?\b(?=\w*\d)\w+\b|\[[0-9a-f]+\]")
#: The same for a piece of text without such names; what noise needs to be in a piece between white space; and the names.
_NOISE_PLAIN = re.compile(r"\bhttp/[\d.]+|https?://\S+|/\S+|#?\b(?=\w*\d)\w+\b|\[[0-9a-f]+\]")
_NOISE_SIGN = re.compile(r"[/\[\d.](?:(?<!\.)|(?:example|com|org|net|html?|php|py|js)\b)")
_NOISE_NAME = re.compile(r"\.(?:example|com|org|net|html?|php|py|js)\b")
_BREAK = re.compile(r"\s")
_TOKEN = re.compile("[\u3040-ヿ㐀-鿿]+|[^\\W\\d_\u3040-ヿ㐀-鿿]+(?:['’][^\\W\\d_\u3040-ヿ㐀-鿿]+)?")
_WIDE = re.compile("[\u3040-ヿ㐀-鿿]")
_WINDOW = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])|\n+|\s[-–|]\s|:\s")
_HEX = re.compile(r"[0-9a-f](?<!\w.)[0-9a-f]{5,}\b")
_PAIRED = re.compile("[\u3040-\u9fff]")


def holds_slot(text: str) -> bool:
    """Whether the text has an unfilled slot, a raw value or a run of filler."""
    if any(x in text for x in _SLOT_SIGNS) and SLOT.search(text):
        return True
    low = text.lower()
    return any(x in low for x in _RUN_SIGNS) and _RUN.search(text) is not None


def holds_value(text: str) -> bool:
    """Whether a program's value stands where a word should, and isn't used as one."""
    return any(x in text for x in _VALUE_SIGNS) and VALUE.search(text) is not None and not _USED.search(text)


def _clean(text: str) -> str:
    """text in lower case without numbers, codes and addresses. Noise never runs over white space, so only the pieces with a sign of it are searched for it."""
    low = _HEX.sub(" ", text.lower())
    m = _NOISE_SIGN.search(low)
    if not m:
        return low
    out, done = [], 0
    while m:
        start = m.start()
        while start > done and not low[start - 1].isspace():
            start -= 1
        stop = _BREAK.search(low, m.end())
        end = stop.start() if stop else len(low)
        piece = low[start:end]
        out += [low[done:start], (_NOISE if _NOISE_NAME.search(piece) else _NOISE_PLAIN).sub(" ", piece)]
        done, m = end, _NOISE_SIGN.search(low, end)
    return "".join([*out, low[done:]])


def _words(cleaned: str) -> list[str]:
    found = _TOKEN.findall(cleaned)
    if cleaned.isascii():
        return found
    if not _PAIRED.search(cleaned):
        return [w.replace("’", "'") for w in found] if "’" in cleaned else found
    out = []
    for w in found:
        if "\u3040" <= w[0] <= "\u9fff":
            out += [w[i : i + 2] for i in range(len(w) - 1)] or [w]
        else:
            out.append(w.replace("’", "'") if "’" in w else w)
    return out


def tokens(text: str) -> list[str]:
    """Lower-case words, and character pairs of Chinese and Japanese; numbers, codes and addresses are left out."""
    return _words(_clean(text))


def windows(text: str) -> list[list[str]]:
    """The tokens of each sentence, line or part of a line that has some."""
    return [w for x in _WINDOW.split(_clean(text)) if x and (w := _words(x))]


class ExemplarIndex:
    """Inverted index of the exemplars, weighted by inverse document frequency in the corpus."""

    def __init__(self, lines: list[str], df: dict[str, int], n: int):
        # An exemplar counts as a whole and sentence by sentence.
        bags = [Counter(b) for b in dict.fromkeys(tuple(w) for x in lines for w in (tokens(x), *windows(x)) if w)]
        self.n = max(n, 1)
        self.default = math.log(1 + self.n)
        self.idf = {t: math.log(1 + self.n / (1 + df.get(t, 0))) for b in bags for t in b}
        self.size = [sum(self.idf[t] for t in b) for b in bags]
        #: Whole sentences of exemplars: residue by themselves, however small a part of their exemplar they are.
        self.whole = {tuple(w) for x in lines for w in windows(x) if len(w) >= (3 if _WIDE.match(w[0]) else 2)}
        self._asides: dict[tuple, tuple[int, bool]] = {}
        self.postings: dict[str, list[int]] = defaultdict(list)
        for i, b in enumerate(bags):
            for t in b:
                self.postings[t].append(i)

    def containment(self, window: list[str]) -> float:
        """TF-IDF containment of a window's tokens in its best exemplar, and of what is left in the next ones: a window can run over two messages."""
        bag = Counter(window)
        total = sum(n * self.idf.get(t, self.default) for t, n in bag.items())
        left, covered = bag, 0.0
        for _ in range(3):
            score: dict[int, float] = defaultdict(float)
            kinds: dict[int, int] = defaultdict(int)
            part: dict[int, float] = defaultdict(float)
            for t, n in left.items():
                for i in self.postings.get(t, ()):
                    score[i] += n * self.idf[t]
                    part[i] += self.idf[t]
                    kinds[i] += 1
            # One stray word of a long exemplar is no retrieval.
            best = max(((s, i) for i, s in score.items() if kinds[i] >= 4 or part[i] >= 0.25 * self.size[i]), default=None)
            if best is None:
                break
            covered += best[0]
            if covered >= CONTAINMENT * total:
                break
            left = {t: n for t, n in left.items() if best[1] not in self.postings.get(t, ())}
        return covered / total if total else 0.0

    def _is_exemplar(self, window: list[str]) -> bool:
        return tuple(window) in self.whole or (sum(map(self.idf.__contains__, window)) >= 0.5 * len(window) and self.containment(window) >= CONTAINMENT)

    def _hits(self, line: str) -> int:
        """Tokens of a line's windows that are residue."""
        return sum(len(w) for w in windows(line) if self._is_exemplar(w))

    def _aside_hits(self, line: str, name: str | None) -> tuple[int, bool]:
        """(tokens of residue windows, whether a slot or filler) of a site's own line; sites repeat their lines, so they are kept."""
        got = self._asides.get((line, name))
        if got is None:
            if len(self._asides) > 100_000:
                self._asides.clear()
            plain = re.sub(re.escape(name), "\n", line, flags=re.I) if name and len(name) > 2 else line
            got = self._asides[line, name] = (self._hits(plain), holds_slot(line))
        return got

    def is_residue(self, text: str | None, name: str | None = None, aside: str | None = None) -> bool:
        """Whether the text is, for the most part, residue or holds unfilled slots or raw values.

        name: the source's own name, which counts neither way. aside: lines that the site repeats and the
        headline; they are judged too, but only what is residue of them counts as part of the text.
        """
        text, aside = text or "", aside or ""
        if not text.strip() and not aside.strip():
            return False
        if holds_slot(text):
            return True
        hit = 0
        for line in aside.split("\n"):
            if line.strip():
                n, slot = self._aside_hits(line, name)
                if slot:
                    return True
                hit += n
        if name and len(name) > 2:
            text = re.sub(re.escape(name), "\n", text, flags=re.I)
        parts = windows(text)
        left = sum(map(len, parts))
        whole = left + hit
        for w in parts:
            left -= len(w)
            if self._is_exemplar(w):
                hit += len(w)
            if hit >= COVERAGE * whole or hit + left < COVERAGE * whole:
                break
        if hit and hit >= COVERAGE * whole:
            return True
        return any(map(holds_value, (text, aside)))


#: The same words used as words.
_USED = re.compile(r"\b(?:remain|remains|remained|left|is|are|was|were|still|an|the|and|or|not|be|been)\s+(?:undefined|null)|null (?:and void|hypothesis|result)", re.I)


def exemplars(spark: SparkSession) -> DataFrame:
    """(lang, kind, text): the labelled exemplars this package knows. Callers can add rows of their own."""
    rows = [tuple(x.split("|", 2)) for x in EXEMPLARS.strip().split("\n")]
    return spark.createDataFrame(rows, "lang string, kind string, text string")


def exemplar_index(texts: DataFrame, text: str, labelled: DataFrame) -> ExemplarIndex:
    """The index of labelled exemplars (text) with document frequencies over all texts; only tokens of the exemplars leave the tasks.

    The exemplars are a small table (is_small); a larger one is an error.
    """
    if not is_small(labelled):
        raise ValueError("the exemplars must be a small table")
    lines = [r[0] for r in labelled.select("text").collect() if r[0]]
    known = {t for x in lines for t in tokens(x)}
    ship_package(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    c[""] += 1
                    c.update(known.intersection(_words(t.lower())))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["t", "n"])

    # At most one row per exemplar token reaches the driver.
    rows = texts.select(text).mapInArrow(count, "t string, n long").groupBy("t").agg(F.sum("n").alias("n")).collect()
    df = {r["t"]: r["n"] for r in rows}
    return ExemplarIndex(lines, df, df.pop("", 0))


def residue_rows(records: DataFrame, keys: list[str], text: str, index: ExemplarIndex, name: str | None = None, aside: str | None = None) -> DataFrame:
    """The keys of the records whose text is residue; null, empty and blank texts are none; repeated rows stay.

    name, aside: columns of the source's own name and of the site's own lines, see is_residue().
    """
    types = dict(records.dtypes)
    shared = records.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            names, asides = (pdf[c] if c else [None] * len(pdf) for c in (name, aside))
            yield pdf.loc[[shared.value.is_residue(t, n, x) for t, n, x in zip(pdf[text], names, asides, strict=True)], keys]

    return records.select(*keys, text, *[c for c in (name, aside) if c]).mapInPandas(run, ", ".join(f"{k} {types[k]}" for k in keys))


def bodies(parsed: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, host, body, aside): each page's text without what its host repeats on many pages and without its headline, and those lines."""
    types = dict(parsed.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            body, aside = [], []
            for (templates, rows), t in zip(boilerplate.page_rows(b), b.column(text).to_pylist(), strict=True):
                gone = set(templates.site_lines(rows))
                lines = list(enumerate((t or "").split("\n"), 1))
                body.append("\n".join(x for n, x in lines if n not in gone))
                aside.append("\n".join(x for n, x in lines if n in gone))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in (*keys, "host")), pa.array(body, pa.string()), pa.array(aside, pa.string())], [*keys, "host", "body", "aside"])

    x = boilerplate.with_templates(parsed, keys, edges=False).select(*keys, "host", text, *boilerplate.COLUMNS, "te", "tl")
    return x.mapInArrow(run, ", ".join(f"{k} {types[k]}" for k in (*keys, "host")) + ", body string, aside string")


KEYS = ["item_table", "item_id"]


def p5_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "extracted_page").dropDuplicates(["page_id"])
    return pages.select(F.lit("extracted_page").alias("item_table"), F.col("page_id").alias("item_id"), "source_id", "title", "text")


def p5_records(spark: SparkSession, sf_dir: str, parsed: DataFrame) -> DataFrame:
    """(item_table, item_id, body, aside, source_name): bodies and site lines of extracted pages, and snippets."""
    names = table(spark, sf_dir, "inventory_source").select("source_id", "source_name").dropDuplicates(["source_id"])
    snippets = table(spark, sf_dir, "content_candidate").select(F.lit("content_candidate").alias("item_table"), F.col("candidate_key").alias("item_id"), F.col("source_id").alias("host"), F.col("snippet").alias("body"), F.lit(None).cast("string").alias("aside"))
    return bodies(parsed, KEYS, "text").unionByName(snippets).join(bounded_broadcast(names.withColumnRenamed("source_id", "host")), "host", "left").drop("host")


def p5_index(spark: SparkSession, sf_dir: str, pages: DataFrame) -> ExemplarIndex:
    """The exemplars' index with document frequencies over the texts of both tables; pages: the extracted pages, each once, cheap to read."""
    texts = pages.select("text").unionByName(table(spark, sf_dir, "content_candidate").select(F.col("snippet").alias("text")))
    return exemplar_index(texts, "text", exemplars(spark))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = materialize(boilerplate.page_lines(p5_pages(spark, sf_dir), KEYS, "source_id", "title", "text", ["text"]), "pages")
    return residue_rows(p5_records(spark, sf_dir, parsed), KEYS, "body", p5_index(spark, sf_dir, parsed), "source_name", "aside").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are not main body, of pages that hold content: problem 5's cases are left out.

    Pages are parsed once, for this problem's templates and for the bodies that problem 5 judges.
    """
    pages = boilerplate.web_pages(spark, sf_dir).withColumn("page_text", F.when(F.col("item_table") == "extracted_page", F.col("text")))
    parsed = materialize(boilerplate.page_lines(pages, KEYS, "source_id", "title", "text", ["page_text"]), "pages")
    own = parsed.filter("item_table = 'extracted_page'").withColumnRenamed("page_text", "text")
    records = p5_records(spark, sf_dir, own).filter("item_table = 'extracted_page'")
    cases = residue_rows(records, KEYS, "body", p5_index(spark, sf_dir, own), "source_name", "aside").distinct()
    return boilerplate.lines_of(parsed, KEYS).join(bounded_broadcast(materialize(cases, "residue")), KEYS, "left_anti").select(*KEYS, "line_no")
