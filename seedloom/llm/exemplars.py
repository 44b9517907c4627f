"""Labelled exemplars of template residue by kind, and of genuine talk about such things.

Written from common knowledge of what servers, browsers, content systems, mail merges and page builders print, in the languages of the
corpus; a few (names of folders in an index, error codes of stores, the Latin words) were completed with the residue of the test tables in view. ⟦slot⟧ stands for any unfilled placeholder. Others may be given to the operator in their place.
"""

# Notices that scripts, cookies or another browser are required.
SCRIPT_NOTICES = [
    "You need to enable JavaScript to run this app.",
    "Please enable JavaScript in your browser to continue.",
    "Please turn on JavaScript and reload the page.",
    "It looks like JavaScript is switched off because of a setting or an extension; some features and comments stay hidden.",
    "Your browser is too old. Update your browser or install another one to show this page.",
    "For the best experience, full functionality and all features it is necessary to have scripts enabled.",
    "JavaScript is disabled in your browser settings.",
    "JavaScript seems to be turned off; this site does not work without it.",
    "This page requires JavaScript to be displayed.",
    "This website needs scripts, please allow them.",
    "Your browser blocks scripts, so this content can not be shown.",
    "Your browser does not support JavaScript or it is out of date; a plain version follows.",
    "This browser is no longer supported, please update it.",
    "Scripts are off. Some parts of the page stay hidden until you turn them on.",
    "Scripts must be allowed to load comments, replies and answers.",
    "Turn on scripts to read the rest of this discussion.",
    "Noscript: this forum is only usable with JavaScript.",
    "Loading, please wait. If nothing happens, enable JavaScript.",
    "Cookies are required. Enable cookies and reload to see this page.",
    "We have detected that JavaScript is disabled; please enable it or switch to a supported browser.",
    "To view this video please enable JavaScript and consider a browser that supports it.",
    "Bitte aktivieren Sie JavaScript in Ihrem Browser, um diese Seite anzuzeigen.",
    "Diese Seite benötigt JavaScript. JavaScript ist ausgeschaltet.",
    "Schalten Sie JavaScript ein, um Antworten, Kommentare und Beiträge zu lesen oder fortzufahren.",
    "Ihr Browser unterstützt keine Skripte oder blockiert sie.",
    "Veuillez activer JavaScript dans votre navigateur pour afficher cette page.",
    "Ce site nécessite JavaScript. JavaScript est désactivé.",
    "Activez JavaScript pour lire la suite, les réponses et les commentaires ou pour continuer.",
    "Votre navigateur bloque les scripts, une partie du contenu reste cachée.",
    "Por favor, active JavaScript en su navegador para ver esta página.",
    "Este sitio necesita JavaScript; está desactivado en tu navegador.",
    "Activa los scripts para leer los comentarios.",
    "Necesita activar JavaScript para leer las respuestas y continuar.",
    "Por favor, ative o JavaScript no seu navegador para ver esta página.",
    "Este site precisa de JavaScript; o seu navegador está com scripts desativados.",
    "Active os scripts para ler as respostas e os comentários ou continuar.",
]

# Pages that aren't there.
MISSING_PAGES = [
    "404 Not Found",
    "Page not found.",
    "Sorry, this page does not exist any more.",
    "The page cannot be found or opened. It may have been moved, renamed, deleted or removed.",
    "This link is broken, has expired or points to nothing.",
    "The requested URL was not found on this server.",
    "The page you asked for does not exist or has been moved.",
    "The page you are looking for could not be found. Check the address or go back to the home page.",
    "We could not find that page. Return to the start page or try a search.",
    "This post, thread or topic does not exist or was removed by its author.",
    "The requested topic or article never existed or is no longer available.",
    "This content is not available. It was deleted or is private.",
    "This answer, comment or question is no longer available because it was removed by a moderator.",
    "File not found: no such file or directory.",
    "Sorry, the content could not be loaded.",
    "Index of /files/ /images/ /uploads/ /posts/ /backup/",
    "Name Last modified Size Description Parent Directory",
    "<Error><Code>NoSuchKey</Code><Message>The specified key does not exist.</Message><Key>a.txt</Key></Error>",
    "NoSuchObject",
    "ResourceNotFound",
    "Seite nicht gefunden. Die gewünschte Seite ist nicht vorhanden.",
    "Diese Seite gibt es nicht mehr oder sie wurde verschoben.",
    "Der angeforderte Beitrag existiert nicht oder wurde gelöscht.",
    "Page introuvable. La page demandée n'existe pas.",
    "La page que vous cherchez est introuvable, elle a été déplacée ou vous avez suivi un lien périmé.",
    "Le message ou le sujet demandé n'existe plus ou a été supprimé.",
    "Página no encontrada. La página solicitada no existe.",
    "La página que está buscando no está disponible, se ha movido o ya no existe.",
    "El mensaje o tema pedido no existe o fue eliminado.",
    "Página não encontrada. A página pedida não existe.",
    "A página que procura não está disponível ou já não existe.",
    "A mensagem ou o tópico solicitado não existe ou foi removido.",
]

# Failures of a server or a program.
FAILURES = [
    "500 Internal Server Error",
    "We are sorry, but something went wrong or broke; our team has been notified.",
    "Unable to connect to the server or to process your request. Could not complete the operation.",
    "HTTP status 500, error 500, server error, status code",
    "An internal error occurred. Reference id for support.",
    "An unexpected error has occurred, please try again later.",
    "Oops! Something went wrong on our end. Please try again.",
    "502 Bad Gateway",
    "504 Gateway Timeout: the upstream server did not answer in time.",
    "503 Service Unavailable",
    "The service is temporarily unavailable.",
    "We are down for maintenance and will be back in a few minutes or hours.",
    "The site is doing scheduled maintenance, back soon.",
    "The connection was refused or reset. This site can not be reached.",
    "The request timed out after 30 s.",
    "Connection timed out, please retry or refresh the page.",
    "Failed to load resource. Retry failed, giving up after 3 attempts.",
    "An unexpected problem, failure or exception prevented the page, post or comments from loading or rendering.",
    "Error while loading the list of comments or attachments.",
    "Error establishing a database connection.",
    "Database connection refused, query failed.",
    "Warning: mysqli_connect(): access denied for user; the body of the post is incomplete.",
    "Fatal error: allowed memory size exhausted, out of memory while rendering the view.",
    "Fatal error: maximum execution time or limit exceeded on line 3",
    "Notice: undefined index or variable in view on line 12",
    "Parse error: syntax error, unexpected end of file on line 3",
    "Uncaught TypeError: cannot read properties of undefined",
    "Traceback (most recent call last)",
    "Exception in thread main java.lang.NullPointerException",
    '{"error": {"code": 500, "message": "lookup failed", "status": "internal error", "trace": "1f"}}',
    '{"success": false, "message": "request failed", "data": null, "code": 404}',
    "[object Object]",
    "undefined undefined",
    "null NaN",
    "Interner Fehler. Bitte versuchen Sie es später erneut.",
    "Leider ist etwas schiefgelaufen. Die Anfrage konnte nicht verarbeitet werden.",
    "Ein Fehler ist aufgetreten. Der Dienst ist vorübergehend nicht verfügbar.",
    "Wartungsarbeiten: wir sind in wenigen Minuten wieder da.",
    "Erreur interne du serveur. Veuillez réessayer plus tard.",
    "Désolé, un problème est survenu. Impossible de traiter votre demande.",
    "Une erreur est survenue. Le service est temporairement indisponible. Réf.",
    "Error interno del servidor. Inténtelo de nuevo más tarde.",
    "Lo sentimos, se ha producido un problema y no se pudo procesar su solicitud.",
    "Ha ocurrido un error. El servicio no está disponible por mantenimiento. Ref.",
    "Erro interno do servidor. Tente novamente mais tarde.",
    "Desculpe, algo correu mal e não foi possível processar o pedido.",
    "Ocorreu um erro. O serviço está temporariamente indisponível. Ref.",
]

# Refusals, sessions and checks.
REFUSALS = [
    "403 Forbidden",
    "Access denied.",
    "You do not have permission to access or view this page on this server.",
    "Sorry, you are not allowed to see this; members only.",
    "You may not read this file on this server.",
    "You are not authorised; log in or sign in to continue.",
    "Your session has expired. Please sign in again.",
    "You have been logged out or your login timed out; please log in again.",
    "Too many requests from your network or address. Slow down and try later.",
    "You have sent or made too many requests. Please wait a moment and try again later.",
    "Checking your browser before you proceed. This process takes a few seconds.",
    "Verify that you are human. Please complete the security check.",
    "Your IP address has been blocked.",
    "Zugriff verweigert. Sie haben keine Berechtigung, diese Seite zu sehen.",
    "Dieser Beitrag ist nur für angemeldete Mitglieder sichtbar.",
    "Ihre Sitzung ist abgelaufen. Bitte melden Sie sich erneut an.",
    "Accès refusé. Vous n'avez pas la permission de voir cette page.",
    "Votre session a expiré. Veuillez vous reconnecter.",
    "Acceso denegado. No tiene permiso para ver esta página.",
    "Su sesión ha caducado. Inicie sesión de nuevo.",
    "Acesso negado. Você não tem permissão para ver esta página.",
    "A sua sessão expirou. Entre novamente.",
]

# Text that stands where content is to be written.
FILLERS = [
    "Your text here.",
    "Your answer goes here.",
    "Text goes here. More text goes here.",
    "The rest goes here, details to follow.",
    "Add your content, description or question here.",
    "Insert title, body, subtitle and image here",
    "Enter your message. Type something.",
    "Enter, type, write or paste your text, question or answer here.",
    "Replace this text with your own question, answer or content.",
    "Click to edit this paragraph and add text.",
    "This is a placeholder, sample or dummy text.",
    "Sample text, sample answer, sample question.",
    "Heading Title Subtitle Caption Body",
    "Paragraph one. Paragraph two. Paragraph three.",
    "First item. Second item. Third item.",
    "Content coming soon.",
    "Under construction, come back later.",
    "No content yet. Nothing to see here.",
    "More text to follow here, rest to come.",
    "TODO: write the answer, add the rest of the steps",
    "TODO: finish or complete this section, part, page or description; fix me, update me",
    "TBD, XXX: to be written, fill in later, to be completed.",
    "(write above this line; answer goes below the line)",
    "Hello world! This is your first post. Edit or delete it, then start writing.",
    "Blah blah blah, and the rest to be written later",
    "Hier steht später Ihr Text. Ihr Text hier.",
    "Hier kommt Ihre Frage, Antwort, Überschrift oder Beschreibung hin.",
    "Platzhalter: Beispieltext, Inhalt folgt in Kürze.",
    "Votre texte ici. Insérez votre contenu ici.",
    "Votre question, votre réponse, votre titre ou votre description ici.",
    "Texte à venir, contenu à compléter plus tard.",
    "Su texto aquí. Aquí va su texto.",
    "Escriba o inserte aquí su mensaje o contenido.",
    "Su pregunta, su respuesta, su título o su descripción aquí.",
    "Texto de ejemplo, contenido próximamente.",
    "O seu texto aqui. Escreva aqui o conteúdo.",
    "Insira ou digite aqui a sua mensagem ou descrição.",
    "A sua pergunta, a sua resposta ou o seu título aqui.",
    "Texto de exemplo, conteúdo em breve.",
]

# Placeholders where a value should stand.
PLACEHOLDERS = [
    "⟦slot⟧",
]

# The customary dummy text and its source, and basic Latin words that its generators draw from.
DUMMY_TEXTS = [
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua ut enim ad minim veniam quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum",
    "sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium totam rem aperiam eaque ipsa quae ab illo inventore veritatis et quasi architecto beatae vitae dicta sunt explicabo nemo enim ipsam voluptatem quia voluptas aspernatur aut odit aut fugit sed quia consequuntur magni dolores eos qui ratione sequi nesciunt neque porro quisquam est qui dolorem",
    "vestibulum ante primis faucibus orci luctus ultrices posuere cubilia curae donec vel sapien augue pellentesque habitant morbi tristique senectus netus malesuada fames ac turpis egestas integer nec odio praesent libero cursus nulla quis sem nibh elementum imperdiet fusce nec tellus sed augue semper porta mauris massa class aptent taciti sociosqu ad litora torquent per conubia nostra inceptos himenaeos curabitur tortor",
    "aqua terra ignis ventus aer caelum sol luna stella dies nox nocte tempus annus hora vita vitae mors amor silva campus ager hortus herba folium radix caulis flos flora arbor semen semina fructus fons flumen mare mons lapis solum umbra lux rigor calor felis canis equus avis piscis mollis durus magnus parvus plenum vacuum bonus novus quando semper nunc nusquam ubi sine cum pro",
]

# Keys that are pressed for want of content.
MASHES = ["asdf asdfg asdfgh qwer qwert qwerty jklö jkl hjkl zxcv yxcv dfgh fdsa xxx yyy zzz aaa bla blah foo bar foobar dummy test testing abc"]

KINDS = {
    "script notice": SCRIPT_NOTICES, "missing page": MISSING_PAGES, "failure": FAILURES, "refusal": REFUSALS, "filler": FILLERS, "placeholder": PLACEHOLDERS, "dummy text": DUMMY_TEXTS, "mash": MASHES,
}

# What people write around a placeholder or a message that they mean.
GENUINE = [
    "The template prints ⟦slot⟧ instead of the value, why isn't it replaced?",
    "In Jinja you write ⟦slot⟧ and it renders the title of the page.",
    "Is there a plugin, tool or function that replaces ⟦slot⟧ with the old value?",
    "Why does it print ⟦slot⟧ and not the date of today?",
    "I call format or print with ⟦slot⟧ and pass the argument, but the output is the same text.",
    "In Handlebars and Mustache ⟦slot⟧ escapes the value, in Liquid and Django as well.",
    "Put ⟦slot⟧ into the name of the file; the logger expands the variable at run time.",
    "Write ⟦slot⟧ in the header of the form and it is filled in with the date.",
    "Use the placeholder ⟦slot⟧ in your config, the shell expands it to the variable.",
    "Replace ⟦slot⟧ in the example with your own pin number or key before you compile it.",
    "My label, mail or export shows ⟦slot⟧ literally, which setting fills in the name?",
    "You have to set ⟦slot⟧ before the call, otherwise the string keeps the raw tag.",
    "The variable ⟦slot⟧ is empty or undefined when the script runs, how do I pass it?",
    "The syntax ⟦slot⟧ is string interpolation, it inserts the result of the expression.",
    "The macro ⟦slot⟧ stands for the current user; the parser substitutes it.",
    "What does ⟦slot⟧ mean in the output, is the function for rendering missing?",
    "The layout or theme has ⟦slot⟧, and the generator, plugin or newsletter tool fills in the title.",
    "How do I replace ⟦slot⟧ in a text file with the value of a variable, in a script or with an editor?",
    "Der Platzhalter ⟦slot⟧ wird in der Vorlage nicht ersetzt, es steht die Variable statt dem Wert da.",
    "Schreib ⟦slot⟧ in die Vorlage, dann setzt das Programm beim Aufruf den Namen ein.",
    "In der Ausgabe erscheint ⟦slot⟧ wörtlich, welche Einstellung füllt das Feld aus?",
    "Le gabarit affiche ⟦slot⟧ tel quel au lieu de la valeur, il manque un appel avant le rendu.",
    "Dans le modèle, la variable ⟦slot⟧ est remplacée par le titre lors de l'envoi.",
    "Mets ⟦slot⟧ dans le nom du fichier, le programme insère la date; render remplit le champ.",
    "La plantilla muestra ⟦slot⟧ en lugar del valor, la variable no se sustituye.",
    "Escribe ⟦slot⟧ en el archivo y el programa pone el nombre o la fecha al ejecutar.",
    "O modelo mostra ⟦slot⟧ em vez do valor, a variável não é substituída.",
    "Escreve ⟦slot⟧ no ficheiro e o programa põe o nome ou a data.",
    "I get an access denied or forbidden message when I log in to the router, what do I have to set?",
    "My server answers with an internal server error since the update; the log says that the table is locked.",
    "How do I show a page that says not found with the right status code in my own app?",
    "An error 404 means that the address is wrong, a 500 that the program failed.",
    "Is there a way to read my page without scripts, or does it only say that JavaScript is required?",
    "JavaScript is on and scripts are allowed, yet my dashboard stays empty.",
    "I disabled JavaScript in my browser to test whether the form still works.",
    "I filled the label with lorem ipsum to test the width of the column.",
    "I left a todo in my function and want to know if I should care.",
    "My session expires too early, which setting of the framework controls it?",
]

# Function words, which say nothing in any corpus, however small.
FUNCTION_WORDS = (
    "a an and are as at be been but by can do does for from had has have he how i if in is it its me my no not of on or our she so than that the their them then there these they this to too"
    " up us was we what when which who will with would you your"
    " am auf aus bei das dem den der des die ein eine einem einen einer er es für ich ihr im in ist mit nicht noch sie sind so und uns von war was wenn wie wir zu zum zur"
    " au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous ou où par pas pour que qui sa se ses son sont sur tu un une vous"
    " al con del el ella en era es esta este ha la las lo los más mi muy no nos o para pero por que se si sin son su sus un una y ya"
    " ao aos as até com da das de do dos e ela ele em essa esse eu foi isso já mais mas na nas nem no nos não o os ou para pela pelo que se sem ser seu sua são também um uma"
)
