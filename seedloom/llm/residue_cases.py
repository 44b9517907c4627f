"""Cases that residue detection is measured on, labelled by hand; none of them is an exemplar.

The operator doesn't read them; only the query and the tests that measure it do. UNSEEN cases were used to choose its parameters and to see which
kinds of messages the exemplars lacked. HELD_OUT cases were written after that; no exemplar comes from them, but their results were looked at while the
last parameters were settled. FRESH cases were written when everything was settled and changed nothing: 27 of the 37 residues were found (0.73),
1 of the 20 genuine sentences was marked.
"""

# Residue of other kinds of systems than the exemplars'.
UNSEEN_RESIDUE = [
    # script and browser walls
    "This application needs JavaScript. Enable it in the settings of your browser and reload.",
    "Hey there! It looks like scripts are blocked. Allow them to continue reading this post.",
    "For full functionality of this site it is necessary to enable JavaScript.",
    "Your browser is not supported. Please switch to another browser.",
    "Comments are hidden because JavaScript is turned off.",
    "JavaScript required to display this content",
    "Your browser is too old to show this page, update your browser.",
    "Ihr Browser hat JavaScript deaktiviert. Bitte aktivieren Sie JavaScript.",
    "JavaScript est désactivé dans votre navigateur, activez JavaScript pour continuer.",
    "Su navegador no tiene JavaScript activado, por favor active JavaScript.",
    "Ative o JavaScript no navegador para continuar.",
    # missing pages
    "HTTP Error 404. The requested resource is not found.",
    "The page cannot be found. It may have been removed or its name changed.",
    "Sorry, this page does not exist anymore.",
    "The topic you requested does not exist.",
    "The thread you are looking for was deleted.",
    "This answer is no longer available because it was removed.",
    "Content not found",
    "File does not exist.",
    "Diese Seite existiert nicht mehr.",
    "La page que vous avez demandée est introuvable.",
    "La página que busca no existe.",
    "O tópico pedido não existe.",
    # failures
    "HTTP Status 500 - Internal Server Error",
    "We're sorry, but something went wrong.",
    "Unable to connect to the database server.",
    "The server is temporarily unable to service your request due to maintenance. Please try again later.",
    "Service unavailable. The server is down, please try again in a few minutes.",
    "An error occurred while loading the comments. Reload the page.",
    "Unexpected error: request timed out, please retry.",
    "The database is down, query failed with an error.",
    "Fatal error: uncaught exception, out of memory on line 42",
    "Warning: undefined variable on line 7",
    '{"status": "error", "code": 503, "message": "service unavailable"}',
    "undefined undefined",
    "Upstream request timeout",
    "Es ist ein interner Fehler aufgetreten. Bitte versuchen Sie es erneut.",
    "Une erreur interne est survenue, veuillez réessayer.",
    "Se ha producido un error interno del servidor.",
    "Ocorreu um erro interno. Tente mais tarde.",
    # refusals
    "You are not allowed to view this page. Please log in.",
    "Permission denied. You do not have access to this file.",
    "Session timed out, please log in again.",
    "You have sent too many requests. Please wait and try again later.",
    "Please complete the security check to access this page.",
    "Access to this page is forbidden.",
    "Sie haben keine Berechtigung für diesen Beitrag.",
    "Vous n'avez pas accès à cette page.",
    "Su sesión ha expirado, inicie sesión.",
    # fillers
    "Enter your text here.",
    "Add a description here",
    "Your question goes here",
    "Type your message here.",
    "[content to be added later]",
    "TODO: fill in the rest",
    "Sample paragraph. Replace with your own text.",
    "This is dummy text and will be replaced later.",
    "This page is under construction.",
    "Answer to follow.",
    "Ihr Text steht hier.",
    "Insérez votre texte ici",
    "Escriba su texto aquí",
    "Insira o seu texto aqui",
    "asdfasdf asdf qwerty",
    "xxxxx xxxxx xxxxxxx",
    "Dolore magna aliqua ut labore, consectetur ipsum elit.",
    "Nulla luctus augue sed mauris vel tortor, fusce libero.",
    # placeholders
    "Dear *|FNAME|*, your order is on its way.",
    "Hi {{ contact.first_name | title }}, we missed you!",
    "Posted by {$author} in {$category}",
    "Welcome to <<Company Name>>!",
    "%s replied to your comment.",
    "{0} people liked this.",
    "Regards,\n[Company Name]",
    "The best soil for {!Plant__c.Name} is loam.",
    "$TITLE$ - $SITENAME$",
    "Sow [%crop%] in {{{month}}}.",
    # of all kinds
    "This feature requires JavaScript. Turn it on and try again.",
    "Scripts are disabled. Enable them to see the answers.",
    "Please allow scripts and cookies for this site to continue.",
    "Loading comments... JavaScript is required.",
    "We noticed that your browser blocks JavaScript.",
    "Aktivieren Sie JavaScript, um die Kommentare zu lesen.",
    "Activez JavaScript pour lire les réponses.",
    "Active JavaScript en su navegador para ver los comentarios.",
    "Error 404: page not found",
    "The document you requested was not found on this server.",
    "This question was removed and is no longer available.",
    "Sorry, we could not find the page you requested.",
    "Die angeforderte Seite wurde nicht gefunden.",
    "La page demandée a été supprimée.",
    "La página solicitada no está disponible.",
    "A página solicitada não foi encontrada.",
    "500 - Server error. Please try again in a few minutes.",
    "An unexpected error prevented this page from loading.",
    "The site is temporarily down for maintenance.",
    "Could not connect to the database.",
    "Gateway error: the server did not respond in time.",
    "Failed to load comments. Please refresh the page.",
    "Fatal error: maximum execution time exceeded on line 88",
    '{"code": 500, "error": "internal server error"}',
    "Der Server ist vorübergehend nicht verfügbar.",
    "Le serveur est temporairement indisponible.",
    "El servicio no está disponible, inténtelo más tarde.",
    "Erro do servidor, tente de novo mais tarde.",
    "You need permission to view this content.",
    "Your session has ended. Please log in again.",
    "Rate limit exceeded. Too many requests.",
    "Please verify that you are not a robot.",
    "Zugriff auf diese Seite verweigert.",
    "Placeholder text. Replace it with your content.",
    "Write your answer here.",
    "Description coming soon",
    "TODO: finish this section",
    "Content will be added soon.",
    "Hier kommt Ihr Text hin.",
    "Votre réponse ici",
    "Lorem ipsum dolor sit amet, sed do eiusmod.",
    "qwerty qwerty asdf",
    "Hello {{user.name}}, your plant {{plant}} is ready.",
    "Thank you, [Customer Name], for your visit.",
    "The harvest of %(crop)s starts in ${month}.",
    "Order #{order_id} was shipped to @@address@@",
]

# Genuine sentences about the same things, or that merely sound like them.
UNSEEN_GENUINE = [
    "In Jinja you write {{ title }} and it prints the page title.",
    "The mail template shows {{ name }} instead of the customer's name, what is wrong?",
    "I use ${HOME} in the config file and the shell expands it before the script runs.",
    "When I call format, %(value)s is printed literally in the output.",
    "Put {crop} in the template string and pass the crop as an argument.",
    "Why does the label print %DATE% instead of today's date?",
    "Set {{ page.title }} in the layout file and the generator fills in the title.",
    "The variable {$author} is empty in my Smarty template.",
    "In der Vorlage steht {{ name }}, aber in der Ausgabe fehlt der Wert.",
    "Le modèle affiche {{ prix }} au lieu de la valeur du champ.",
    "La plantilla imprime {{ nombre }} en vez del valor de la variable.",
    "I get a 404 for every image since I moved my site to a new server.",
    "My app returns an internal server error when the sensor sends an empty value.",
    "How do I make the page work without JavaScript for my readers?",
    "The router says access denied even though I typed the right password.",
    "I turned JavaScript off and the comments are gone, is that expected?",
    "After the update the database refuses connections from my laptop.",
    "My session ends after ten minutes although I set an hour.",
    "The index page of my garden blog is slow to load.",
    "I wrote a todo list for the spring, what did I forget?",
    "The service of the nursery was excellent.",
    "Please try it with fresh compost next time.",
    "You may need to enable the pump before you open the valve.",
    "The request came from my neighbour, who wants the seeds.",
    "No answer yet from the shop, so I repaired it myself.",
    "I could not find the page in the manual that explains the timer.",
    "The server in the shed overheats in summer.",
    "Your text helped me a lot, thank you.",
    "The title of the book is on the first page.",
    "Turn on the heating mat and wait a few days.",
    "The first post of the fence is rotten, the rest is fine.",
    "My browser shows the chart, the tablet does not.",
    "An error in the wiring made the relay click all night.",
    "The file is there, but the script reads the wrong line.",
    "Test the soil before you add lime.",
    "The sample from bed two was too wet to test.",
    "Die Seite mit den Sorten lädt bei mir sehr langsam.",
    "Ich habe später noch einmal gegossen, ohne Erfolg.",
    "La page du fabricant ne dit rien sur la pression.",
    "El error estaba en el cable del sensor.",
    "O servidor da estufa desliga quando faz calor.",
    "Is there a plugin that replaces %TITLE% in old posts?",
    "My form prints [object Object] when I join the two lists, how do I show the name?",
    "I filled the page with lorem ipsum to check the layout and the footer moved.",
    "The message body is empty when I send it from the command line.",
    "I have to sign in again every morning, which cookie setting is wrong?",
    "The connection between the hose and the tap leaks.",
    "Does this bean need support, or does it stand on its own?",
    "The answer depends on the depth of the bed and the season.",
    "Nothing happens when I press the button of the timer.",
    "In Twig you put {{ post.title }} in the template and it shows the title.",
    "Why does my newsletter show {{first_name}} instead of the name of the reader?",
    "The script writes ${date} into the file name because I forgot to expand the variable.",
    "How do I replace %NAME% in a text file with the value of a variable?",
    "My function prints {value} literally, the f before the string is missing.",
    "In der Vorlage schreibe ich {{ titel }}, aber der Wert wird nicht eingesetzt.",
    "Dans mon gabarit {{ date }} reste tel quel, que manque-t-il ?",
    "My site shows a 404 after I changed the permalinks, how do I fix the rewrite rules?",
    "The nursery's website is down, does anyone have their phone number?",
    "I cannot log in because the session cookie is not set.",
    "The script needs a server with more memory.",
    "Is JavaScript the right language for a small sensor dashboard?",
    "My browser is old and the garden planner does not load in it.",
    "The service technician could not find the error.",
    "I requested a new key from the shop and got no answer.",
    "The text on the label is too small to read.",
    "Try again in spring when the soil is warm.",
    "The page of the diary for June is missing.",
    "Add your compost in autumn and the rest in spring.",
    "Nothing was found when we tested the soil.",
    "The connection of the hose is broken.",
    "Please check the timer before you replace the battery.",
    "Die Verbindung zum Sensor bricht nachts ab.",
    "Je ne trouve pas la page avec le plan du jardin.",
    "No encuentro el error en mi consulta.",
    "O pedido chegou tarde e sem as sementes.",
    "It works now, the file had the wrong permissions.",
    "You can edit the first line of the file to change the interval.",
    "I left the title empty because I had no better idea.",
    "The answer is on the second page of the manual.",
]

# Residue that no exemplar was written from.
HELD_OUT_RESIDUE = [
    "JavaScript must be enabled in order to use this forum.",
    "This content is only visible with scripts turned on.",
    "Please upgrade your browser to view this page.",
    "Enable JavaScript to load the answers to this question.",
    "It seems that scripts are blocked by your browser.",
    "Bitte schalten Sie JavaScript ein und laden Sie die Seite neu.",
    "Pour afficher le contenu, activez JavaScript.",
    "Debe activar JavaScript para ver este contenido.",
    "É necessário ativar o JavaScript para ver este site.",
    "404: this page could not be found.",
    "Oops, that page does not exist.",
    "The post you are looking for has been deleted.",
    "Sorry, this content is no longer available.",
    "No such file or directory",
    "Beitrag nicht gefunden",
    "Ce message n'existe pas ou a été supprimé.",
    "Este tema ya no existe.",
    "Esta página foi removida.",
    "Internal error, please try again.",
    "Something went wrong while loading this page.",
    "Error 502 Bad gateway",
    "The request could not be completed because the server timed out.",
    "The service is unavailable due to scheduled maintenance.",
    "Database error: connection failed",
    "Warning: undefined index on line 4",
    '{"message": "not found", "status": 404}',
    "Fehler beim Laden der Seite. Bitte versuchen Sie es später.",
    "Une erreur s'est produite, veuillez réessayer plus tard.",
    "Error del servidor, inténtelo de nuevo.",
    "Ocorreu um erro ao processar o pedido.",
    "Access is denied. Please sign in.",
    "You are not authorised to read this topic.",
    "Your session expired, log in again to continue.",
    "Too many requests, please slow down.",
    "Checking that you are human. This may take a few seconds.",
    "Accès interdit à cette page.",
    "Enter a title here",
    "Insert text here",
    "Your description goes here.",
    "Sample content, to be replaced.",
    "TODO: write this part later",
    "More content coming soon.",
    "Ihre Antwort hier",
    "Texte à insérer ici",
    "Su respuesta aquí",
    "Ut enim ad minim veniam, quis nostrud.",
    "asdf asdf asdf",
    "Good morning {{ customer.first_name }}, your seeds have arrived.",
    "The next watering is due on <%= due_date %>.",
    "Welcome back, ${user}!",
    "Dear [Name], your crate leaves on %DAY%.",
]

# Genuine sentences that no exemplar was written from.
HELD_OUT_GENUINE = [
    "In the Jinja template I write {{ page.title }} and the output has no title.",
    "Why is %(name)s not replaced when I call the function?",
    "The export prints ${value} instead of the number, which option expands the variable?",
    "How can I show {{ name }} literally in a page without the template replacing it?",
    "Put __VERSION__ in the source file and the build script replaces it with the number.",
    "Im Brief steht {{ anrede }} statt dem Namen, welche Variable fehlt der Vorlage?",
    "La plantilla muestra {{ fecha }} y no la fecha, ¿qué valor falta?",
    "Our forum returned a 502 all morning, so I ask here.",
    "The nursery says the page for the beans was removed by mistake.",
    "I denied the app access to my location and the frost alarm stopped.",
    "My script runs out of memory when I load all readings.",
    "Does the planner need JavaScript or does it work in a plain browser?",
    "The error message of the pump controller disappears too fast.",
    "Which browser do you use to view the harvest table?",
    "The server room is too warm for seedlings.",
    "He asked me to sign the form and send it again.",
    "There is not enough space on the page for a second table.",
    "Please find the photo of the leaf below.",
    "Try to write the date on every label.",
    "The sample text in the manual shows the right format.",
    "We lost the connection to the weather station in the storm.",
    "The first paragraph of the guide explains the soil test.",
    "Later in the season you can add the rest of the compost.",
    "Your answer was very helpful, it works.",
    "Die Antwort steht auf der zweiten Seite des Hefts.",
    "Le service de la jardinerie était lent.",
    "La respuesta depende del suelo.",
    "O erro desapareceu depois da atualização.",
    "No, the valve is not available any more, they replaced it.",
    "Do you have to be logged in to see the map of the beds?",
]

# Residue, written when everything was settled.
FRESH_RESIDUE = [
    "Your browser has JavaScript disabled, so comments cannot be shown.",
    "Please enable scripts to view the full discussion.",
    "JavaScript is needed to run this page.",
    "This widget does not work without JavaScript.",
    "Um diese Seite zu sehen, aktivieren Sie bitte JavaScript.",
    "Merci d'activer JavaScript.",
    "Para continuar, habilite JavaScript.",
    "Error 404. The file you requested does not exist.",
    "We can't find the page you are looking for.",
    "This thread has been removed by a moderator.",
    "Resource not found",
    "Die Seite konnte nicht gefunden werden.",
    "Cette page n'est plus disponible.",
    "El contenido no existe.",
    "Error 500: internal server error. Please contact support.",
    "Sorry, an error occurred. Please try again later.",
    "Service temporarily down for maintenance.",
    "Connection to the server was lost. Retry.",
    "Database query failed",
    "Unhandled exception in module",
    "503 - the server is overloaded",
    "Der Dienst ist zurzeit nicht verfügbar.",
    "Un problème est survenu, réessayez.",
    "Servidor no disponible",
    "You must be logged in to view this content.",
    "Your account has been blocked.",
    "Please sign in to read the rest.",
    "Write your comment here",
    "Title goes here",
    "Placeholder",
    "Text to be added",
    "TBD",
    "Lorem ipsum dolor",
    "Hello %%NAME%%, welcome",
    "Dear {first_name},",
    "Best regards, {{ sender }}",
    "Sow {{crop}} in [Month].",
]

# Genuine sentences, written when everything was settled.
FRESH_GENUINE = [
    "The template engine leaves {{ crop }} in the page when the value is null.",
    "I wrote ${path} in the script and the shell expands it to nothing.",
    "How can I get rid of a 404 in my log file?",
    "My neighbour's server is down again.",
    "I can't find the seeds I was looking for.",
    "The page loads, but the chart is empty.",
    "He removed the thread from the screw.",
    "Why do scripts that read the sensor fail at night?",
    "Please sign the list if you want to help.",
    "The title of my post was too long.",
    "Does the service include delivery?",
    "The maintenance of the pump takes an hour.",
    "The first error is in line two of my query.",
    "You can view the data in any browser.",
    "Der Server im Keller läuft seit Jahren.",
    "La page du livre est abîmée.",
    "No pude conectar la manguera.",
    "The comment under the photo explains it.",
    "Write the date on the label with a pencil.",
    "The content of the bag is compost.",
]
