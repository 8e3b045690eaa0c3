"""The labelled table that the personal-data model learns from: [kind|span] marks a span."""

# Invented contact lines, and lines of numbers that are not personal data.
LABELLED = """
Call me at [phone|+1 (415) 555-0100] today
His number is [phone|+44 20 7946 0958], her number is [phone|+44 20 7946 0001].
Phone: [phone|(212) 555-0147]
tel [phone|212-555-0188] or fax [phone|212-555-0189]
Please ring [phone|(030) 555 01 23] after five
Contact [phone|+49 30 5550123] for details
mobile [phone|+33 6 12 34 56 78] works best
You can reach us on [phone|800-555-0199] all day.
the desk answers [phone|+1 (017) 555-7713] in the morning
Rufen Sie [phone|+49 (0) 30 555 0144] an
appelez le [phone|+33 1 55 50 12 34] demain
llame al [phone|+34 915 550 123] por favor
Telephone [phone|(020) 7946 0321], ask for Ann
my cell is [phone|415-555-2671] and hers [phone|415-555-2672]
write to [email|ann.lee@mail.example.com] soon
Send it to [email|bob_92@host2.example.org], please.
[email|office@example.net] is read daily
My address is [email|j.doe+news@mail.example.co.uk]
von [email|karl-heinz.34@post.example.de] erhalten
contact: [email|x1@a.example]
reply at [email|info@example.com]; or [email|sales@example.com]
mail [email|that.92@mail2.example.com] or call [phone|+1 (499) 555-6503]
the host [ip|192.0.2.17] is down
ping [ip|198.51.100.4] and [ip|203.0.113.250] again
Server at [ip|10.0.0.1]:8080 answered
from [ip|172.16.254.3] to [ip|172.16.254.9]
address [ip|97.51.17.173] seen in the log
IP=[ip|203.0.113.9], port 22
card [card|4111 1111 1111 1111] was charged
Paid with [card|5500-0000-0000-0004] yesterday
number [card|4012888888881881] expires 09/27
la carte [card|5105 1051 0510 5100] est valable
Karte [card|378282246310005] belastet
use [card|6011111111111117] for the order
tarjeta [card|4000-0000-0000-0002] y nada
account card: [card|30569309025904].
the year 2019 and the year 2020 were good
In 1999, 45 people bought 1,200 items for 3,400.50 each.
Version 1.2.3 of the program came out on 2021-03-14
chapter 3.1.4 and section 12.2 are short
at 10:45 or 11:30 we meet in room 204
Order 20210-33 has 12 lines, total 199.99
it costs $12.50, or 15.20 with tax
pages 12-18 and 33-40 of volume 7
ISBN 978-3-16-148410-0 is a sample
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" then
hash 9e107d9d372bb6826bd81d3542a419d6 of the file
the ratio is 3.14159265358979 or so
a score of 3 - 2 and 15 - 40 in set 2
on 14.03.2021 and on 15/04/2021 the office was closed
see rule 12 (3) and rule 14 (2) of act 5
between 100 000 and 200 000 people
Tel Aviv and Phoenix are towns
The cat sat on the mat, and that was that.
Of and the with*** this&&& are not words
THE!! CAT!! SAT!! ON!! THE!! MAT!!
one | two | three | four
Licensed under the Apache License, Version 2.0.
This work is licensed under CC BY-NC 4.0.
under the GNU General Public License, version 3.
Et les deux ont dit que non, en 1789.
Der Zug um 12.30 Uhr hat 5 Wagen.
El tren de las 7 tiene 12 coches.
@home is a word, and #7 is a mark
50% of 20 is 10, and 10% of 50 is 5
file_2021_03.txt has 12345 bytes in 3 parts
call [phone|020 7946 0322] after nine
ring [phone|020 7946 0455] or [phone|0161 496 0123] please
Tel. [phone|0171/5550188] im Haus
Telefon [phone|089/5550147], bitte nur morgens
Tel [phone|0172/5550199] heute
Tel: [phone|040/5550122]
phone [phone|555-0123] for a table
my number is [phone|555-0162], hers is [phone|555-0171]
our phone: [phone|555.0190.22] or [phone|415.555.2688]
text me on [phone|415.555.2690] tonight
fax [phone|0044 20 7946 0777] is old
call [phone|07700 900123] now
appelez le [phone|01 70 18 01 23] ou le [phone|06.12.34.56.79]
llame al [phone|915 550 177] hoy
host [ip|192 . 0 . 2 . 18] is slow
the server [ip|198 . 51 . 100 . 7] went down
block {ip|192.0.2[.]19} and {ip|198.51.100[.]23} at once
seen from {ip|203[.]0[.]113[.]8} today
traffic to {ip|203.0.113(.)9} was dropped
ping [ip|2001:db8::8a2e:370:7334] from there
the address [ip|2001:db8:0:1::7] answers
route to [ip|fe80::1c2:3ff:fe4] is up
at [ip|2001:db8::1] and at [ip|2001:db8::2]
write {email|ann.lee [at] mail.example.org} soon
contact {email|bob [at] example.com} for more
mail to {email|karl (at) post.example.de} please
send it to {email|jo.doe (at) example (dot) org} today
reach me: {email|info[at]example[dot]net}
ask [email|sales at example dot com] about it
write to [email|mary at mail dot example dot org] now
mail [email|tom at host dot org] or ring [phone|555-0114]
card [card|4111.1111.1111.1111] was used
paid by [card|5500.0000.0000.0004] in May
Karte [card|4012/8888/8888/1881] gesperrt
we met at example dot and at noon
at 10 at night they stop at the dot
we look at the dot on the map
at that at on the dot com boom
see section 192.0 and part 2.17 of the text
the values 12 . 5 and 3 . 7 were rounded
the scores were 21-15 and 555 to 012
room 555, seat 0123, row 4
items 020, 7946 and 0321 are sold out
the time 12:30:45 and the ratio 16:9 are fine
bible 3:16 and verse 4:2 are read
lot 2001:7 was sold at 10:30
invoice 0171-5550 of 2021 is paid
add 1.5 and 2.25 to 3.125
dates 01.02.2023 and 12/31/2022 were free
mobile: [phone|06.98.76.54.32] le soir
joindre au [phone|01.70.18.02.34] ou au [phone|04 70 18 05 67] svp
fixe [phone|02 70 18 03 45], portable [phone|07.12.34.56.01]
message [email|ana-maria.7@mail.example.es] recibido
mail [email|jean-luc@poste.example.fr] ou [email|marie-claire.12@mail.example.fr] svp
proxy [ip|10.0.0.7]:3128 refused, then [ip|192.0.2.5]:443 answered
write {email|eva [at] example.net} for details
contact {email|lee [at] example.org} or {email|kim [at] mail.example.net} first
mail [email|ian at post dot net] or call [phone|555-0177]
write to [email|amy at box dot example dot net] for more
card [card|378282246310005] expires 11/28, code 123
""".strip().split("\n")
