"""The small labelled table of the url filter: whole urls, 1 for those of the usual subjects of block lists, 0 for others and for an empty one."""

#: Fixed values, made up or of widely known sites; one url a line, in blocks by subject.
LABELLED = """
1 https://www.bet365.com/en/sports/live-betting
1 https://1xbet.com/casino/slots
1 https://sports.betway.com/en/horse-betting
1 https://www.williamhill.com/betting/odds
1 https://www.betfair.com/exchange/football-bets
1 https://m.mybookie.ag/sportsbook/odds
1 https://www.888casino.com/live-roulette
1 https://luckycasino24.net/free-spins
1 http://royal-vegas-casino.biz/no-deposit-bonus
1 https://www.pokerstars.eu/poker/real-money
1 https://partypoker.com/en/poker-bonus
1 https://onlinepokerroom.info/holdem
1 https://slotomania-slots.com/free-slots/jackpot
1 https://bestslots777.top/spin
1 https://www.megajackpotwin.com/lottery/tickets
1 https://lottoland-tickets.co/euro-lotto
1 https://bingo-bonus-hall.com/bingo/join
1 https://gamblingtips.xyz/win-at-blackjack
1 https://online-betting-bonus.bet/signup
1 https://roulette-winner.casino/system
1 https://www.pornhub.com/video/categories
1 https://www.xvideos.com/best
1 https://xhamster.com/amateur-porn
1 https://www.redtube.com/teen-sex
1 https://youporn.com/watch/anal
1 https://freeporntube.org/porn/milf
1 https://www.xnxx.com/hardcore-sex
1 https://hotsexcams.live/webcam-girls
1 https://chaturbate-cams.com/nude-cams
1 https://onlyfansleaks.tv/nude-photos
1 https://www.adultfriendfinder.com/adult-dating
1 https://adultxxxmovies.net/xxx
1 https://hentaihaven.xxx/hentai
1 https://nudegirls4u.com/gallery/erotic
1 https://escort-girls-berlin.de/escorts
1 https://sexchat-live.net/sex-chat
1 https://erotic-stories-archive.com/erotica
1 https://camgirls-online.com/nude/live
1 https://milfdating.club/hot-singles
1 https://tube8.com/xxx-porn-videos
1 https://thepiratebay.org/torrent/top
1 https://1337x.to/torrents/movies
1 https://yts-torrents.mx/movie-torrent
1 https://rarbg-proxy.com/torrent-download
1 https://www.fullcrack.org/software-crack-keygen
1 https://crackedgames.net/pc-cracked
1 https://warez-bb.org/warez
1 https://serialkeygen.info/keygen/serial
1 https://nulledscripts.io/nulled-themes
1 https://putlocker-free-stream.to/watch-free-movies
1 https://123movies-free.sc/free-movies-stream
1 https://piratedebooks.ws/pirate-books
1 https://mp3-torrentz.com/pirated-music
1 https://buy-viagra-online.com/viagra-without-prescription
1 https://cheapmeds-pharmacy.ru/cialis-generic
1 https://canadianpharmacy24h.com/buy-cialis
1 https://dietpills-shop.net/weight-loss-pills
1 https://xanax-no-prescription.biz/buy-pills
1 https://steroids4sale.com/buy-anabolic-steroids
1 https://rx-pills-online.info/cheap-pills
1 https://keto-slim-pills.club/miracle-diet
1 https://viagra-cialis-shop.com/order
1 https://ad.doubleclick.net/ddm/clk
1 https://ib.adnxs.com/getuid
1 https://ads.pubmatic.com/AdServer/js
1 https://adserver.popads.net/pop
1 https://track.clickbooth.com/click
1 https://popunder-ads.com/adserve
1 https://www.adclickexchange.com/banner-ads
1 https://trackers.adtrack-pixel.net/pixel
1 https://cdn.taboola-ads.com/clickbait
1 https://click.mailspam-tracker.com/open
1 https://bulk-email-spam.net/spam-lists
1 https://ads-network.click/ad/redirect
1 https://payday-loans-fast.com/payday
1 https://quickcash-loans.biz/no-credit-check
1 https://instantpaydayloan.net/apply-now
1 https://get-rich-quick-forex.com/easy-money
1 https://bitcoin-doubler.xyz/double-btc
1 https://free-iphone-giveaway.win/claim-prize
1 https://you-won-a-prize.top/claim-free-gift
1 https://winfreegiftcards.club/free-prize
1 https://paypal-login-verify.tk/account-update
1 https://secure-bank-login.ml/verify-account
1 https://apple-id-verify-account.ga/login
1 https://malware-spyware-download.cc/exe
1 https://replica-watches-rolex.cn/replica
1 https://cheap-replica-handbags.com/fake-louis
1 https://fakeid-shop.cc/buy-fake-id
1 https://hot-singles-in-your-area.com/join-free
1 https://free-ringtones-spam.biz/win
1 https://make-money-fast-online.biz/easy-cash
1 https://spamhouse-mailer.ru/bulk-mail
1 https://clickfarm-likes.com/buy-likes
1 https://seo-link-farm.biz/backlinks
1 https://cheapviagra-pills.org/cheap
0 https://en.wikipedia.org/wiki/Photosynthesis
0 https://de.wikipedia.org/wiki/Berlin
0 https://www.bbc.co.uk/news/science-environment-5321
0 https://www.nytimes.com/2020/05/11/books/review.html
0 https://www.theguardian.com/education/2019/jun/02/teachers
0 https://www.lemonde.fr/culture/article/2021/03/04
0 https://elpais.com/internacional/2020-01-12/elecciones.html
0 https://www.spiegel.de/wissenschaft/natur/a-1234.html
0 https://www.nature.com/articles/s41586-019-1234-5
0 https://arxiv.org/abs/1706.03762
0 https://www.ncbi.nlm.nih.gov/pmc/articles/PMC3209
0 https://pubmed.ncbi.nlm.nih.gov/2938471/
0 https://www.jstor.org/stable/2346178
0 https://docs.python.org/3/library/itertools.html
0 https://github.com/apache/spark/issues/77
0 https://stackoverflow.com/questions/11227809/why-is-it-faster
0 https://developer.mozilla.org/en/docs/Web/HTML
0 https://news.ycombinator.com/item
0 https://www.gutenberg.org/ebooks/1342
0 https://archive.org/details/texts
0 https://www.loc.gov/collections/maps/
0 https://www.nasa.gov/mission/voyager/
0 https://www.noaa.gov/weather/forecast
0 https://www.usgs.gov/earthquakes/map
0 https://europa.eu/rapid/press-release
0 https://www.parliament.uk/business/bills/
0 https://www.service.gov.uk/manual/design
0 https://www.bundestag.de/dokumente/texte
0 https://www.essex.ac.uk/departments/history
0 https://www.sussex.ac.uk/study/masters
0 https://www.mit.edu/research/robotics/
0 https://ocw.mit.edu/courses/mathematics/
0 https://www.stanford.edu/academics/
0 https://www.uni-heidelberg.de/en/study
0 https://www.sorbonne.fr/recherche/
0 https://www.coursera.org/learn/statistics
0 https://www.khanacademy.org/math/algebra
0 https://www.britannica.com/animal/caterpillar
0 https://www.merriam-webster.com/dictionary/pillar
0 https://www.allrecipes.com/recipe/crackers-and-cheese
0 https://www.bbcgoodfood.com/recipes/apple-pie
0 https://www.chefkoch.de/rezepte/kuchen
0 https://www.marmiton.org/recettes/quiche
0 https://www.kingarthurbaking.com/blog/bread
0 https://www.seriouseats.com/cocktail-basics
0 https://www.nationalgeographic.com/animals/birds
0 https://www.rspb.org.uk/birds-and-wildlife
0 https://www.gardenersworld.com/plants/roses
0 https://www.rhs.org.uk/advice/pruning
0 https://www.farmersalmanac.com/weather
0 https://www.metmuseum.org/art/collection
0 https://www.louvre.fr/en/explore/the-palace
0 https://www.moma.org/calendar/exhibitions
0 https://www.tate.org.uk/art/artworks/turner
0 https://www.rijksmuseum.nl/en/rijksstudio
0 https://www.berlinerphilharmoniker.de/konzerte
0 https://www.classical-music.com/soundtrack-reviews
0 https://www.chess.com/article/openings
0 https://www.fifa.com/tournaments/worldcup
0 https://www.olympics.com/en/athletes
0 https://www.trackandfieldnews.com/results
0 https://www.cyclingtips.org/trackside-report
0 https://www.bahn.de/service/fahrplan
0 https://www.sncf.com/fr/itineraire
0 https://www.nationalrail.co.uk/stations/leeds
0 https://www.flightradar24.com/data/airports
0 https://www.lonelyplanet.com/tibet
0 https://www.visitscotland.com/places/highlands
0 https://www.tripadvisor.com/Restaurants-Lisbon
0 https://www.mayoclinic.org/diseases/asthma
0 https://www.nhs.uk/conditions/back-pain
0 https://www.who.int/health-topics/malaria
0 https://www.cancer.org/treatment/therapists.html
0 https://www.redcross.org/give-blood
0 https://www.ifixit.com/Guide/battery
0 https://www.gnu.org/software/emacs/
0 https://www.kernel.org/doc/html/latest
0 https://www.debian.org/releases/stable
0 https://wordpress.org/themes/
0 https://www.postgresql.org/docs/current/
0 https://blog.rust-lang.org/2021/05/11/edition.html
0 https://www.economist.com/finance/2020/07
0 https://www.ft.com/content/markets
0 https://www.worldbank.org/en/topic/poverty
0 https://www.imf.org/en/publications
0 https://www.creditunion-advice.org/savings
0 https://www.weather.com/forecast/tenday
0 https://www.timeanddate.com/calendar
0 https://www.poetryfoundation.org/poems/sonnet
0 https://www.goodreads.com/book/show/4671
0 https://www.alphabetical-library.org/index.html
0 https://www.betterhomes-and-gardens.org/ideas
0 https://www.windmill-museum.nl/opening-hours
0 https://www.woodworking-forum.net/carpentry/joints
0 https://www.village-school.org.uk/parents
0 https://www.townlibrary.example/events/2020/
0 http://blog.quiet-mountain.net/en/1234.html
0 http://m.northern-rivers.org/fr/77
0 https://www.oldstation-theatre.co.uk/programme
0 https://shop.handmade-pottery.eu/es/bowls
0 https://www.astronomy-club.info/de/42/
0 https://forum.vintage-radios.com/en/9001
0 none://
""".split("\n")
