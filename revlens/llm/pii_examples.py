"""Labelled personal data: the small table that the random field of operator 7 learns from.

Each line is a text with marked spans, ``<<kind:...>>``; all names and numbers
are made up. Beside forms that the base patterns find, the lines hold forms
that they miss: numbers without a country code, addresses spelled out or
masked, cards of other lengths or with other separators, IPv6, and spans that a
base pattern loses because a number stands next to them. The other lines hold
what looks alike and is none.

``examples`` varies the lines by rule: digits are drawn anew, so that cards keep
their check digit and octets stay octets. A line and its variations always lie
in one part of five; part ``HELD`` is never learned from.
"""

from __future__ import annotations

import random
import re
import zlib

LINES = """
call me at <<phone:555-0134>> after lunch
phone <<phone:(415) 555-0182>> or write
her mobile is <<phone:0171 2345678>> in the evening
Telefon <<phone:030 / 1234567>> im Büro
tel. <<phone:01 42 68 53 00>> à Paris
tel: <<phone:01.42.68.53.00>> le matin
móvil <<phone:612 345 678>> gracias
teléfono <<phone:91 123 45 67>> en casa
fax <<phone:212-555-0147>> for the papers
ring <<phone:020 7946 0958>> and ask for Tom
text <<phone:07700 900123>> when you land
dial <<phone:1-800-555-0199>> free of charge
phone: <<phone:5550123>> ask for Mary
cell <<phone:415.555.0166>> any time
you can reach us on <<phone:(020) 7946 0018>> daily
my number is <<phone:202-555-0173>> call back
amex <<card:371449 635398 431>> again
your card <<card:4111  1111  1111  1111>> ends
steps of 200 400 600 800 metres
numbers 300 500 700 in a row
write <<email:kim at lab dot example dot ac dot uk>> today
mail <<email:lee at dept dot uni dot ac dot uk>> now
ask <<email:max at web dot host dot co dot nz>> first
contact <<email:nina.ross at mail dot city dot gov dot uk>> please
amex <<card:3714 496353 98431>> was used
amex ending <<card:3787 344936 71000>> expired
corporate amex <<card:3787-344936-71000>> lost
móvil <<phone:644 123 987>> mañana
call <<phone:622 555 101>> tonight
his phone <<phone:0049 30 1234567>> from abroad
call <<phone:00 33 1 42 68 53 00>> from abroad
Handy <<phone:0160-5551234>> bitte abends
whatsapp <<phone:(11) 5555-0101>> or mail
mobile <<phone:07700900456>> thanks
call <<phone:555-0117>> or <<phone:555-0119>> today
reach me on <<phone:+1 (826) 555-4081>> <<ip:190.137.223.204>> was the host
from <<phone:+44 20 7946 0958>> <<ip:10.20.30.40>> as logged
call <<phone:+1 (743) 555-3824>> please
phone <<phone:+49 30 1234567>> in Berlin
anna <<phone:+34 612 345 678>> en Madrid
mail <<email:anna at example dot com>> for details
write to <<email:bob.smith at mail dot example dot org>> soon
contact <<email:info [at] shop [dot] de>> for prices
email <<email:carol (at) uni (dot) edu>> about the exam
mail me: <<email:dave(at)example.com>> thanks
contact <<email:erin[at]example[dot]net>> please
reach <<email:frank at mail.example.com>> or (at) the desk
her address is <<email:grace.hopper at navy dot org>> I think
e-mail <<email:j42 at example dot info>> works
email: <<email:support {at} example {dot} io>> day and night
send it to <<email:jörg@müller.de>> bitte
schreib an <<email:käthe@example.de>> morgen
mail <<email:heidi_at_home(at)web(dot)de>> gern
contact <<email:ivan at news dot example dot co dot uk>> now
or <<email:judy @ example.com>> if you like
email <<email:mallory @ mail.example.org>> first
mail <<email:me@example.com>> or call
write to <<email:first.last92@mail6.example.com>> today
contact <<email:a.b+c@example.org>> please
pay with card <<card:4845/1681/1440/7329>> today
card <<card:4845.1681.1440.7329>> expires soon
visa <<card:4111_1111_1111_1111>> was charged
amex <<card:3782 822463 10005>> on file
amex card <<card:378282246310005>> declined
old visa <<card:4222222222222>> number
card no. <<card:4845  1681  1440  7329>> in the mail
credit card <<card:5500-0000-0000-0004>> ok
card <<card:4845168114407329>> 12 is the month
visa <<card:5500000000000004>> 27 code
Karte <<card:4845 / 1681 / 1440 / 7329>> gesperrt
charge <<card:4845 1681 1440 7329>> now
number <<card:4845168114407329>> on the form
tarjeta <<card:4845:1681:1440:7329>> caducada
host <<ip:fe80::1ff:fe23:4567:890a>> is down
from <<ip:2001:db8::ff00:42:8329>> at night
server <<ip:2001:0db8:85a3:0000:0000:8a2e:0370:7334>> answered
ping <<ip:2001:db8:0:1:1:1:1:1>> failed
blocked <<ip:10[.]0[.]0[.]1>> in the log
attacker <<ip:192[.]168[.]13[.]7>> seen
address <<ip:172(.)16(.)254(.)1>> masked
host <<ip:203[dot]0[dot]113[dot]9>> masked
login from <<ip:10.0.0.255>> today
server <<ip:192.168.1.17>> is up
the year 1984 and 2001 were dry
from 1939-1945 in the war
on 2024-05-17 we met
on 17.05.2024 we met again
due 05/17/2024 at noon
at 10:45 or 18:30 daily
at 10:45:30 the clock stopped
version 3. of the license
version 4.0. of the text
CC BY-NC 4.0. applies here
release 1.2.3 and 1.2.4 shipped
build 2.10.1234 is out
order 9807915762804490 was sent
number 9233400261099 of the list
serial 9807915762804490 is not a card
isbn 978-3-16-148410-0 is a book
isbn 9783161484100 on the cover
invoice 20240517 of May
part 1234-5678 is out of stock
part no. 555-0134-A in the shelf
ticket 555-0134 is closed
pages 120-134 of the book
section 3.1.4 of the code
section 10.2.3.999 of the manual
price 1,234,567 in total
it cost 12.50 or 13.75 each
room 412 on floor 3
about 1200 people and 350 dogs
100 200 300 400 are the steps
the numbers 1 2 3 4 5 6 7
scores of 21 17 and 9
2 + 2 is 4 and 3 + 4 is 7
C++ and A+ were given
token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b" here
hash 9f86d081884c7d659a2feaa0c55ad015 of it
id 550e8400-e29b-41d4-a716-446655440000 of the row
see @anna and @bob for more
meet @ noon or @ the bar
please send it to <<email:olga at posta dot com>> today
they wrote to <<email:paul at firma dot de>> again
a polka dot dress at home
she is at home dot dot dot
peter sat at the dot org chart
it is at work dot and done
connect the dot and look at it
the dot com bubble in 1999
he looked at the dot on the map
stand at the red dot now
we sat (at) the table
the width is 1920x1080 pixels
at 3:15 pm on May 4
chapter 12 verse 7
model 8800-2211 of the pump
zip 94103-1234 in the west
grid 12 34 56 78 on the map
ratio 16:9 and 4:3
time 12:34:56:78 of the frame
std::vector a:b::c 3::4
room 030 / 12 upstairs
4111 1111 were the results
key 4845/1681 in the log
""".strip().splitlines()

PARTS, HELD = 5, 4
_MARK = re.compile(r"<<(\w+):(.*?)>>")
_RUN = re.compile(r"[0-9]+")
#: Dates, times and years stay as written.
_KEPT = re.compile(r"[0-9]{1,4}([-./:])[0-9]{1,2}\1[0-9]{1,4}(?![-./:][0-9])|[0-9]{1,2}:[0-9]{2}(?![0-9])|(?:1[89]|20)[0-9]{2}(?![0-9])|([0-9]+)")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _drawn(m: re.Match, rng: random.Random) -> str:
    return "".join(c if c == "0" and k == 0 else str(rng.randint(1 if k == 0 else 0, 9)) for k, c in enumerate(m[0]))


def _varied(kind: str, text: str, rng: random.Random) -> str:
    if kind == "ip":
        return text if text.count(":") > 1 else _RUN.sub(lambda m: str(rng.randint(0, 255)), text)
    text = _RUN.sub(lambda m: _drawn(m, rng), text) if kind else _KEPT.sub(lambda m: _drawn(m, rng) if m[2] else m[0], text)
    if kind == "card" or (kind == "" and len(_RUN.findall(text)) == 1):
        digits = "".join(_RUN.findall(text))
        if kind or len(digits) >= 13:  # cards pass the check, long numbers that are none fail it
            end = next(c for c in "0123456789" if luhn(digits[:-1] + c) == (kind == "card"))
            at = text.rindex(digits[-1])
            text = text[:at] + end + text[at + 1 :]
    return text


def part_of(line: str) -> int:
    return zlib.crc32(line.encode()) % PARTS


def examples(copies: int = 12, seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]], int]]:
    """(text, spans, part): each line as written and ``copies`` variations of it."""
    rng = random.Random(seed)
    out = []
    for line in LINES:
        for copy in range(copies + 1):
            vary = (lambda k, t: _varied(k, t, rng)) if copy else (lambda k, t: t)
            text, spans, done = "", [], 0
            for m in _MARK.finditer(line):
                text += vary("", line[done : m.start()])
                value = vary(m[1], m[2])
                spans.append((m[1], len(text), len(text) + len(value)))
                text += value
                done = m.end()
            out.append((text + vary("", line[done:]), spans, part_of(line)))
    return out
